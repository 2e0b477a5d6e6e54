"""A keyed, partitioned log of messages as a streaming source.

A log is a folder with segments of JSON lines, each the messages of one log
partition from one offset on. A key's messages go to one partition in order, so
a consumer sees every call in order. Segments count when the append that wrote
them is in the index, a file that is written under another name and renamed.

The reader is a Python data source: it has an offset for each partition, starts
at the ``earliest`` or at the ``latest`` message, reads each partition's range
in a task of its own, and goes on from the checkpoint's offsets after a
restart. ``maxMessages`` bounds what a micro-batch takes, but for the first one
after a start. Folders are opened by pyarrow, so ``path`` may be on any file
system that it knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "key string, value string, partition int, offset long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}")


def _write(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, path)


def segments(path: str) -> list[tuple[int, int, int, str]]:
    """partition, first offset, number and file of every segment in the index."""
    fs, root = _open(path)
    found = []
    for f in fs.get_file_info(pafs.FileSelector(f"{root}/index", allow_not_found=True)):
        if f.path.endswith(".json"):
            with fs.open_input_stream(f.path) as s:
                found += [tuple(x) for x in json.loads(s.read())]
    return sorted(found)


def ends(path: str, partitions: int) -> dict[str, int]:
    """The next offset of every partition."""
    out = {str(p): 0 for p in range(partitions)}
    for p, first, n, _ in segments(path):
        out[str(p)] = max(out[str(p)], first + n)
    return out


def append(messages: DataFrame, path: str, order: Sequence[str], partitions: int, key: str = "key", value: str = "value") -> None:
    """Append keyed messages, each partition's in ``order``, as one segment a
    partition. One appender at a time; a failed append leaves the log as it was."""
    base, name = ends(path, partitions), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(path)
        held, at = [], None

        def put():
            file = f"{root}/partition={at}/{base[str(at)]:020d}-{name}.jsonl"
            fs.create_dir(f"{root}/partition={at}", recursive=True)
            _write(fs, file, "".join(held).encode())
            return pa.RecordBatch.from_pydict({"p": [at], "first": [base[str(at)]], "n": [len(held)], "file": [file]})

        for b in batches:
            for p, k, v in zip(*(b[c].to_pylist() for c in ("p", "key", "value"))):
                if p != at and held:
                    yield put()
                    held = []
                at = p
                held.append(json.dumps([k, v]) + "\n")
        if held:
            yield put()

    rows = messages.withColumn("p", F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(partitions)).cast("long"))
    rows = rows.repartition(partitions, "p").sortWithinPartitions("p", *order).select("p", F.col(key).cast("string").alias("key"), F.col(value).alias("value"))
    written = rows.mapInArrow(run, "p long, first long, n long, file string").collect()      # one row a partition
    fs, root = _open(path)
    fs.create_dir(f"{root}/index", recursive=True)
    if written:
        _write(fs, f"{root}/index/{name}.json", json.dumps([list(r) for r in written]).encode())


class _Range(InputPartition):
    def __init__(self, partition: int, start: int, end: int, files: list):
        self.partition, self.start, self.end, self.files = partition, start, end, files


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.path, self.n = options["path"], int(options.get("partitions", 8))
        self.starting, self.most = options.get("startingoffsets", "latest"), int(options.get("maxmessages", 0))
        self.last: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return ends(self.path, self.n) if self.starting == "latest" else {str(p): 0 for p in range(self.n)}

    def latestOffset(self) -> dict:
        # Spark asks for this before it says where the query stands, so the first answer has no bound
        end = ends(self.path, self.n)
        if self.most and self.last is not None:
            each = max(1, self.most // self.n)
            end = {p: min(e, self.last[p] + each) for p, e in end.items()}
        self.last = end
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        found = segments(self.path)
        return [_Range(p, start[str(p)], end[str(p)], [(first, n, f) for q, first, n, f in found if q == p and first < end[str(p)] and first + n > start[str(p)]])
                for p in range(self.n) if end[str(p)] > start[str(p)]]

    def read(self, partition: _Range) -> Iterator[tuple]:
        fs, _ = _open(self.path)
        for first, _, file in partition.files:
            with fs.open_input_stream(file) as s:
                for k, line in enumerate(s.read().decode().split("\n")[:-1]):
                    if partition.start <= first + k < partition.end:
                        key, value = json.loads(line)
                        yield key, value, partition.partition, first + k


class MessageLog(DataSource):
    """``spark.readStream.format("message_log")`` with path, partitions,
    startingOffsets (latest or earliest) and maxMessages."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def stream(spark: SparkSession, path: str, partitions: int, starting: str = "latest", max_messages: int = 0) -> DataFrame:
    spark.dataSource.register(MessageLog)
    return (spark.readStream.format("message_log").option("path", path).option("partitions", partitions)
            .option("startingOffsets", starting).option("maxMessages", max_messages).load())
