"""SimHash near-duplicates through an inverted index of byte positions.

A 64-bit fingerprint is eight bytes. Two fingerprints that differ in at most
``max_bits`` bits differ in at most that many bytes, so they share at least
8 - max_bits of the bytes by value and position: the guaranteed minimum.
Among the first 8 - 1 positions they share at least one less. The index has a
key for every set of that many positions with the bytes found there, so that
the members of a key have a head start, and for a pair met under a key the
shared positional bytes are tallied; a pair that reaches the minimum is
verified by its bit distance. A pair is taken up only under its first common
key.

Copies count once: the index holds distinct fingerprints. Keys with a few
members compare them pair by pair; larger keys link their members by a
traversal that emits at most one link a member, as the classes need no more.
Keys over ``BLOCK`` members are cut into blocks and each pair of blocks is a
unit of its own, so no task holds more than a unit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callscore.session import scratch_root

from . import bloom
from .common import ref, temp_names
from .components import connected_components

#: members of a unit of comparison
BLOCK = 4096
#: keys of at most this many members are compared pair by pair, many at a time
FEW = 16
#: shingles hashed at a time
CHUNK = 1 << 16
INDEXED = 7     # byte positions that keys are made of


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a whole text, A-Z lower-cased;
    a bit is 1 if set in over half of the shingle hashes (XXH64, seed 42)."""
    import xxhash

    words = (text or "").encode().lower().split()      # bytes split at ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        a, b = starts[k:min(k + CHUNK, n)].tolist(), ends[k + shingle - 1:min(k + CHUNK, n) + shingle - 1].tolist()
        hashes = np.fromiter([digest(joined[i:j], 42) for i, j in zip(a, b)], ">u8", len(a))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", fp: str = "fp") -> DataFrame:
    """Every row of ``docs`` but its text, with ``fp``: the fingerprint as a
    signed long."""
    own = [c for c in docs.columns if c != text]
    schema = docs.select(*[ref(c) for c in own], F.lit(0).cast("long").alias(fp)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values.view(np.int64))], names=[*own, fp])

    return docs.select(*[ref(c) for c in own], ref(text).cast("string").alias("_" + text)).mapInArrow(run, schema)


class _Linker:
    """Links among the members of units, given as arrays sorted by unit."""

    def __init__(self, max_bits: int):
        self.max_bits, self.least = max_bits, 8 - max_bits
        self.sets = _position_sets(max_bits)
        # for each pattern of equal bytes the first key under which the pair is met
        first = np.full(1 << INDEXED, -1)
        for pattern in range(1 << INDEXED):
            for k, s in enumerate(self.sets):
                if all(pattern >> p & 1 for p in s):
                    first[pattern] = k
                    break
        self.first = first

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For XORs of pairs: whether each is a link, and its equal bytes."""
        equal = np.ascontiguousarray(x).astype("<u8").view(np.uint8).reshape(-1, 8) == 0
        tally = equal.sum(axis=1)
        hit = tally >= self.least
        hit[hit] = np.bitwise_count(x[hit]) <= self.max_bits
        return hit, equal

    def few(self, unit: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        weights = 1 << np.arange(INDEXED)
        for gap in range(1, FEW):
            at = np.flatnonzero(unit[:-gap] == unit[gap:]) if gap < len(unit) else np.zeros(0, int)
            if not len(at):
                break
            hit, equal = self.near(fp[at] ^ fp[at + gap])
            at, equal = at[hit], equal[hit]
            own = self.first[(equal[:, :INDEXED] * weights).sum(axis=1)] == key[at]
            yield fp[at[own]], fp[at[own] + gap]

    def many(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = fp
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                one = queue.pop()
                hit, _ = self.near(left ^ one)
                found, left = left[hit], left[~hit]
                if len(found):
                    yield np.full(len(found), one), found
                    queue.extend(found)


def _position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of positions among the indexed ones that a linked pair must share
    at least one of: as many positions as it shares there at the least."""
    return list(combinations(range(INDEXED), INDEXED - max_bits))


def _link_units(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = _Linker(max_bits)

        def links(table: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            """All units in ``table`` are whole."""
            keys = (table["key"], table["masked"], table["u"], table["v"])
            new = np.ones(len(keys[0]), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            unit = np.cumsum(new) - 1
            size = np.bincount(unit)
            fp = table["fp"].view(np.uint64)
            small = size[unit] <= FEW
            found = list(linker.few(unit[small], table["key"][small], fp[small]))
            starts = np.concatenate([[0], np.cumsum(size)])
            for k in np.flatnonzero(size > FEW):
                found += linker.many(fp[starts[k]:starts[k + 1]])
            if found:
                a, b = (np.concatenate(c).view(np.int64) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)}
            if held is not None:
                table = {n: np.concatenate([held[n], table[n]]) for n in table}
            # the last unit may go on in the next batch
            same = np.ones(len(table["fp"]), bool)
            for n in ("key", "masked", "u", "v"):
                same &= table[n] == table[n][-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = {n: c[cut:] for n, c in table.items()}
            if cut:
                yield from links({n: c[:cut] for n, c in table.items()})
        if held is not None:
            yield from links(held)

    return run


def near_links(distinct: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Links a, b that connect the fingerprints ``fp`` (distinct signed longs)
    as all pairs at most ``max_bits`` bits apart would."""
    if not 0 <= max_bits < INDEXED:
        raise ValueError(f"max_bits must be 0 to {INDEXED - 1}")
    masks = []
    for s in _position_sets(max_bits):
        mask = sum(0xFF << (8 * p) for p in s)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("key", "masked")
    members = distinct.select("fp", keys).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key", "masked"))).where("n > 1")
    # a key beyond a block is cut into half blocks by hash, and every pair of these is a unit
    parts = F.when(F.col("n") <= block, 1).otherwise(F.ceil(F.col("n") * 2 / block) * 2).cast("int")
    members = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    units = members.select("key", "masked", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    units = units.select("key", "masked", F.least("part", "other").alias("u"), F.greatest("part", "other").alias("v"), "fp")
    units = units.repartition("key", "masked", "u", "v").sortWithinPartitions("key", "masked", "u", "v", "fp")
    return units.mapInArrow(_link_units(max_bits), "a long, b long")


def mark_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and root for each row.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the smallest doc_id that links lead to, root a number of the class. Texts
    of fewer words than a shingle are one shingle; null, empty and wordless
    texts have the fingerprint zero and link like any other. Null ids are left
    out of the minimum (it is null if a class has no other); repeated ids and
    rows are rows like others. Other columns are not read. No rows, no rows.
    """
    scratch_root(docs.sparkSession)
    rows = docs.select(ref(doc_id).alias("doc_id"), ref(text).alias("text"))
    # read twice below and dear to make: kept in the shared folder
    marked = fingerprints(rows, shingle).checkpoint()
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = connected_components(near_links(distinct.select("fp"), max_bits))
    roots = distinct.join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = roots.select("fp", "root").join(smallest, "root")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return marked.join(by_fp, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id", "root")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every class, with the columns of ``docs``: the one with the
    smallest doc_id (null after all others); of several rows with that id the
    one with the smallest hash of all columns; of rows equal in every column
    one.

    The rows to drop are known by id and hash. A Bloom filter of these, of
    fixed size, lets all other rows pass straight through; only rows that may
    be in it are shuffled."""
    scratch_root(docs.sparkSession)
    row, flag, goes, number = temp_names(docs, "row", "flag", "goes", "number")
    hashable = [ref(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    keyed = docs.select(*[ref(c) for c in docs.columns], F.xxhash64(*hashable).alias(row))
    narrow = keyed.select(ref(doc_id).alias("doc_id"), F.col(row).alias("row"), ref(text).alias("text"))
    marked = fingerprints(narrow, shingle).checkpoint()
    classes = connected_components(near_links(marked.select("fp").distinct(), max_bits))
    counted = marked.groupBy("fp", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    rooted = counted.join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = rooted.groupBy("root").agg(F.min(order).alias("first"))
    # rows that go, and rows that stay but are there more than once
    special = rooted.join(first, "root").withColumn("goes", order != F.col("first")).where("goes or n > 1")
    special = special.select(F.col("doc_id").alias("special_id"), F.col("row").alias("special_row"), F.col("goes").alias(goes)).distinct().checkpoint()
    filled = bloom.bitmaps(special.select(F.explode(bloom.cells(F.col("special_row"))).alias("cell")).distinct())
    flagged = bloom.possibly_in(keyed, F.col(row), filled, flag)
    same = ref(doc_id).eqNullSafe(F.col("special_id")) & (F.col(row) == F.col("special_row"))
    maybe = flagged.where(F.col(flag)).join(special, same, "left")
    one = Window.partitionBy(row, ref(doc_id)).orderBy(row)
    maybe = maybe.where(F.coalesce(~F.col(goes), F.lit(True)))
    maybe = maybe.withColumn(number, F.row_number().over(one)).where(F.col(goes).isNull() | (F.col(number) == 1))
    own = [ref(c) for c in docs.columns]
    return flagged.where(~F.col(flag)).select(*own).unionByName(maybe.select(*own))
