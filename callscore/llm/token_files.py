"""Token ids in binary files: one zstandard frame per document, and a seek table.

A file is a zstandard stream of

* one independent frame per document: its ids as little-endian unsigned 32-bit
  integers, in ascending doc_id order;
* a skippable frame with the document index (ids, token counts);
* a skippable frame in the public seekable format: for each frame before it
  the compressed size, the size of its content and the low 32 bits of the
  content's XXH64; then the number of frames, a flag byte and a magic number.

Any zstandard reader can decompress a whole file. A reader of single documents
reads the two tables at the end and decompresses only the frames asked for.

Files are written by Spark's own writer, so they go to any file system that
Spark reaches, and a task that is run again leaves no half-written or doubled
file: each row is one whole file short of its last four bytes, and these are
the writer's "line separator".
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ref
from .tokens import broadcast_tokenizer, encoder_of

# ---- fixed values of the public formats ----
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUM = 0x80

#: a file is closed once its ids take this many bytes before compression
FILE_BYTES = 8 << 20
LEVEL = 1


def _checksum(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class _File:
    """A file in the making; ``close`` returns its bytes."""

    def __init__(self, compressor):
        self.compress = compressor.compress
        self.frames: list[bytes] = []
        self.entries: list[bytes] = []
        self.docs: list[tuple[int | None, int]] = []
        self.raw = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compress(ids)
        self.frames.append(frame)
        self.entries.append(struct.pack("<III", len(frame), len(ids), _checksum(ids)))
        self.docs.append((doc_id, len(ids) // 4))
        self.raw += len(ids)

    def close(self) -> bytes:
        n = len(self.docs)
        index = struct.pack("<I", n) + np.array([d or 0 for d, _ in self.docs], "<i8").tobytes() \
            + np.array([d is None for d, _ in self.docs], "u1").tobytes() + np.array([k for _, k in self.docs], "<u8").tobytes()
        index = struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index
        table = b"".join(self.entries) + struct.pack("<III", len(index), 0, _checksum(b""))
        table += struct.pack("<IBI", n + 1, HAS_CHECKSUM, SEEKABLE_MAGIC)
        return b"".join([*self.frames, index, struct.pack("<II", SKIPPABLE_SEEK, len(table)), table])


class TokenFile:
    """Reader of one file's bytes."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        self.docs: list[tuple[int | None, int]] = []
        if not len(content):
            self.starts, self.entries = np.zeros(1, int), np.zeros((0, 3), "<u4")
            return
        frames, flag, magic = struct.unpack("<IBI", self.content[-9:])
        if magic != SEEKABLE_MAGIC or not flag & HAS_CHECKSUM:
            raise ValueError("not a token file: no seek table at its end")
        self.entries = np.frombuffer(self.content[-9 - 12 * frames:-9], "<u4").reshape(-1, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        at = int(self.starts[frames - 1])
        n, = struct.unpack("<I", self.content[at + 8:at + 12])
        at += 12
        ids = np.frombuffer(self.content[at:at + 8 * n], "<i8")
        null = np.frombuffer(self.content[at + 8 * n:at + 9 * n], "u1")
        counts = np.frombuffer(self.content[at + 9 * n:at + 17 * n], "<u8")
        self.docs = [(None if z else int(d), int(k)) for d, z, k in zip(ids, null, counts)]

    def read(self, k: int, decompressor) -> bytes:
        """The ids of the ``k``-th document, its frame checked."""
        raw = decompressor.decompress(self.content[self.starts[k]:self.starts[k + 1]], max_output_size=int(self.entries[k, 1]))
        if len(raw) != int(self.entries[k, 1]) or _checksum(raw) != int(self.entries[k, 2]):
            raise ValueError(f"frame {k} does not match its checksum")
        return raw


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id",
                      text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Encode every whole text, append ``end_id`` and write the files.

    Documents are dealt out by ranges of (doc_id, text hash) and sorted, so the
    files hold them in ascending doc_id order (null first, equal ids by the
    text's hash). Null or empty texts are documents of the end id alone;
    repeated rows are written as often as they occur; other columns are not
    read. No rows give no documents. ``path`` must not exist yet.
    """
    definition = broadcast_tokenizer(docs.sparkSession, tokenizer)
    src = docs.select(ref(doc_id).cast("long").alias("doc_id"), F.coalesce(ref(text).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("tie", F.xxhash64("text"))
    ordered = src.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode, end = encoder_of(definition), np.array([end_id], "<u4").tobytes()
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        row = lambda f: pa.RecordBatch.from_arrays([pa.array([f.close()[:-4]], pa.binary())], ["content"])
        file = _File(compressor)
        for doc_id, ids in encode.stream(batches):
            file.add(doc_id, ids + end)
            if file.raw >= file_bytes:
                yield row(file)
                file = _File(compressor)
        if file.docs:
            yield row(file)

    tail = struct.pack("<I", SEEKABLE_MAGIC).decode("iso-8859-1")
    (ordered.mapInArrow(files, "content binary").select(F.col("content").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", tail).option("encoding", "ISO-8859-1").option("compression", "none").text(path))


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """One row per document: file, doc_id, place (in the file), file_start (ids
    before it in its file), n_tokens, ids (binary, little-endian unsigned
    32-bit). With ``doc_ids`` only these documents' frames are decompressed."""
    wanted = None if doc_ids is None else set(doc_ids)
    schema = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("place", pa.int64()), ("file_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                name, file, start, rows, size = batch.column(0)[i].as_py(), TokenFile(batch.column(1)[i].as_buffer()), 0, [], 0
                for k, (doc_id, n) in enumerate(file.docs):
                    if wanted is None or doc_id in wanted:
                        rows.append((name, doc_id, k, start, n, file.read(k, decompressor)))
                        size += 4 * n
                    start += n
                    if rows and (size >= FILE_BYTES or k + 1 == len(file.docs)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(docs, "file string, doc_id long, place long, file_start long, n_tokens long, ids binary")


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """file, start: the ids in all files before it. The files' tables alone are
    read, no frame is decompressed. One row per file of ``FILE_BYTES`` is
    ordered, so the ordering stays small beside the input."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file = TokenFile(batch.column(1)[i].as_buffer())
                if file.docs:
                    yield pa.RecordBatch.from_pydict({"file": [batch.column(0)[i].as_py()], "tokens": [sum(k for _, k in file.docs)]})

    files = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(totals, "file string, tokens long")
    # Spark numbers the files of a write by task, then within the task: part-<task>-<uuid>-c<number>
    task = F.regexp_extract("file", r"part-(\d+)-", 1).cast("long")
    number = F.regexp_extract("file", r"-c(\d+)[^/]*$", 1).cast("long")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "tokens", task.alias("task"), number.alias("number")).select(
        "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
