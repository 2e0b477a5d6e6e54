"""Running and final folds over arrays, as a prefix in two levels.

A fold is the number of rows so far, their texts joined by a space and cut,
and for each array column the sum and the number of arrays. Folds of
neighbouring stretches add up to the fold of both, so a key of any size is
folded in buckets:

1. rows are shuffled once by (key, bucket of the order) and stay whole: an
   array travels as an array, and no cell becomes a row;
2. every bucket but a key's last is folded to one row; a walk over these rows,
   1 / ``width`` of the table, gives each later bucket the fold before it. A key
   with a single bucket has none;
3. a walk over the shuffled rows goes on from there, one fold in memory.

Of rows with the same key and order one counts, whole: the one with the least
text, and of equal texts the one whose arrays hash least. An array's shape is
its size and width; the first row (by order) with an array of a column sets the
column's shape for the key. A row with any array of another shape counts in
nothing, and ``misfits`` returns it. Null and empty arrays are none. Copies of
one row meet in one task, which reads them as a sorted stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.arrays import n_cols
from .prefix import int_bucket

WIDTH = 4096            # order values in a bucket
OUT_VALUES = 4 << 20    # array values that a walk holds before it hands rows on
NO_ORDER = -(1 << 62)   # the bucket of null order values, which come first


class Fold:
    """What rows of one key add up to."""

    def __init__(self, n_arrays: int):
        self.n, self.text = 0, ""
        self.sums: list[np.ndarray | None] = [None] * n_arrays
        self.counts = [0] * n_arrays

    def add(self, n: int, text: str, sums: Sequence, counts: Sequence[int], limit: int) -> None:
        """Take the fold of the rows that come next."""
        if n:
            self.text = (text if not self.n else self.text + " " + text)[:limit]
            self.n += n
        for k, (s, c) in enumerate(zip(sums, counts)):
            if c:
                self.sums[k] = s.copy() if self.sums[k] is None else self.sums[k] + s
                self.counts[k] += c

    def means(self) -> list:
        return [s / c if c else None for s, c in zip(self.sums, self.counts)]

    def state(self) -> list:
        return [self.n, self.text, *self.sums, *self.counts]


def _columns(arrays: Sequence[str]) -> str:
    parts = ["_n long", "_text string", *[f"_s{k} array<double>" for k in range(len(arrays))], *[f"_c{k} long" for k in range(len(arrays))]]
    return ", ".join(parts)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column; a null list has no values."""
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _list_array(rows: list) -> pa.Array:
    ends = np.cumsum([0] + [0 if r is None else len(r) for r in rows])
    values = np.concatenate([r for r in rows if r is not None] or [np.zeros(0)])
    mask = pa.array([r is None for r in rows])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.float64()), mask=mask)


def _walk(keys: int, arrays: int, limit: int, schema: StructType, visit: Callable, done: Callable | None) -> Callable:
    """A task's walk over rows sorted by key. Columns: the keys, then what
    ``visit(fold, batch, a, b)`` reads; it takes rows a to b of one key and gives
    output rows. ``done(key, fold)`` gives the row of a key that is over."""
    names_out, types = [f.name for f in schema.fields], [to_arrow_type(f.dataType) for f in schema.fields]

    def table(rows: list) -> pa.RecordBatch:
        columns = [_list_array(list(c)) if pa.types.is_list(t) else pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, names_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, key, rows, held = Fold(arrays), None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = list(zip(*[batch.column(i).to_pylist() for i in range(keys)]))
            a = 0
            while a < len(names):
                b = a + 1
                while b < len(names) and names[b] == names[a]:
                    b += 1
                if names[a] != key:
                    if key is not None and done:
                        rows.append(done(key, fold))
                    fold, key = Fold(arrays), names[a]
                rows += visit(fold, batch, a, b)
                held += sum(0 if s is None else len(s) for s in fold.sums) * (b - a)
                if held > OUT_VALUES and rows:
                    yield table(rows)
                    rows, held = [], 0
                a = b
            if rows and not done:       # rows go on with their batch
                yield table(rows)
                rows, held = [], 0
        if key is not None and done:
            rows.append(done(key, fold))
        if rows:
            yield table(rows)

    return run


def _block(batch: pa.RecordBatch, name: str, a: int, b: int) -> tuple[np.ndarray | None, np.ndarray]:
    """The arrays in rows a to b as one block, and which rows have one."""
    offsets, values = _lists(batch.column(name))
    sizes = np.diff(offsets[a:b + 1])
    has = sizes > 0
    if not has.any():
        return None, has
    return values[offsets[a]:offsets[b]].reshape(int(has.sum()), -1), has


def _rows(df: DataFrame, keys: Sequence[str], order: str, text, arrays: dict[str, str], width: int) -> tuple[DataFrame, DataFrame]:
    """The one shuffle: rows by (key, bucket), copies gone, with the shapes of
    their key, and the table of all (key, bucket) as ``_k0``, ``_k1``, ...

    Sizes are taken after the shuffle, so that both need the same columns of it
    and Spark runs it once."""
    keys = list(keys)
    ks = range(len(arrays))
    rows = df.select(
        *keys, F.coalesce(int_bucket(order, width), F.lit(NO_ORDER)).alias("_bk"), F.col(order).alias("_o"), text.alias("_t"),
        F.xxhash64(*arrays.values()).alias("_h"),
        *[F.flatten(m).cast("array<double>").alias(f"_a{k}") for k, m in enumerate(arrays.values())],
        *[n_cols(m).alias(f"_q{k}") for k, m in enumerate(arrays.values())])
    bucket = [*keys, "_bk"]
    once = Window.partitionBy(*bucket, "_o").orderBy("_t", "_h")
    rows = rows.repartition(*bucket).withColumn("_copy", F.row_number().over(once)).where("_copy = 1").drop("_copy", "_h")
    for k in ks:
        rows = rows.withColumn(f"_w{k}", F.when(F.size(f"_a{k}") > 0, F.struct(F.size(f"_a{k}").alias("size"), F.col(f"_q{k}").alias("cols"))))
    first = rows.groupBy(*bucket).agg(*[F.min_by(f"_w{k}", F.when(F.col(f"_w{k}").isNotNull(), F.struct("_o"))).alias(f"_f{k}") for k in ks])
    whole = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(bucket)],
                         (F.col("_bk") < F.max("_bk").over(whole)).alias("_more"), (F.col("_bk") > F.min("_bk").over(whole)).alias("_later"),
                         *[F.first(f"_f{k}", ignorenulls=True).over(whole).alias(f"_f{k}") for k in ks])
    fits = reduce(lambda a, b: a & b, [F.col(f"_w{k}").isNull() | (F.col(f"_w{k}") == F.col(f"_f{k}")) for k in ks], F.lit(True))
    j = rows.join(first, _same(bucket))
    return j.select(*bucket, "_o", "_t", *[F.when(F.size(f"_a{k}") > 0, F.col(f"_a{k}")).alias(f"_a{k}") for k in ks],
                    *[F.col(f"_f{k}.cols").alias(f"_q{k}") for k in ks], "_more", fits.alias("_fits")), first


def _same(bucket: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(bucket)])


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[StructField]:
    return [df.schema[k] for k in keys]


def _bucket_folds(rows: DataFrame, keys: Sequence[str], arrays: int, limit: int) -> DataFrame:
    """One row for each (key, bucket)."""
    names = [f"_a{k}" for k in range(arrays)]

    def visit(fold: Fold, batch: pa.RecordBatch, a: int, b: int) -> list:
        texts, used, length = [], fold.n > 0, len(fold.text)
        for t in batch.column("_t").slice(a, b - a).to_pylist():
            if length > limit:
                break
            texts.append(t)
            length += len(t) + 1
        blocks = [_block(batch, m, a, b) for m in names]
        # in order, as the running form adds them
        sums = [None if x is None else np.add.accumulate(x if fold.sums[k] is None else np.vstack([fold.sums[k], x]))[-1] for k, (x, _) in enumerate(blocks)]
        joined = " ".join(texts)
        fold.text = ((fold.text + " " + joined) if used else joined)[:limit]
        fold.n += b - a
        for k, (x, has) in enumerate(blocks):
            if x is not None:
                fold.sums[k], fold.counts[k] = sums[k], fold.counts[k] + int(has.sum())
        return []

    bucket = [*keys, "_bk"]
    src = rows.select(*bucket, "_o", "_t", *names).sortWithinPartitions(*bucket, "_o")
    schema = StructType([*_key_fields(src, bucket), *_parse(_columns(names))])
    return src.mapInArrow(_walk(len(bucket), arrays, limit, schema, visit, lambda key, fold: [*key, *fold.state()]), schema)


def _parse(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def _merge(fold: Fold, batch: pa.RecordBatch, r: int, arrays: int, limit: int) -> None:
    """Add the bucket fold in row ``r``."""
    get = lambda c: batch.column(c)[r].as_py()
    sums = [None if not get(f"_c{k}") else np.asarray(batch.column(f"_s{k}")[r].values) for k in range(arrays)]
    fold.add(get("_n"), get("_text"), sums, [get(f"_c{k}") or 0 for k in range(arrays)], limit)


def _by_key(folds: DataFrame, keys: Sequence[str]) -> DataFrame:
    return folds.repartition(*keys).sortWithinPartitions(*keys, "_bk")


def final(df: DataFrame, keys: Sequence[str], order: str, text, arrays: dict[str, str], limit: int, width: int = WIDTH) -> DataFrame:
    """keys, ``n``, ``text`` and the mean of each array column, a row a key.

    ``arrays`` maps output names to columns of matrices (arrays of arrays)."""
    n = len(arrays)
    rows, _ = _rows(df, keys, order, text, arrays, width)
    folds = _bucket_folds(rows.where("_fits"), keys, n, limit)

    def visit(fold: Fold, batch: pa.RecordBatch, a: int, b: int) -> list:
        for r in range(a, b):
            _merge(fold, batch, r, n, limit)
        return []

    schema = StructType([*_key_fields(folds, keys), *_parse(", ".join(["n long", "text string", *[f"`{m}` array<double>" for m in arrays]]))])
    walk = _walk(len(keys), n, limit, schema, visit, lambda key, fold: [*key, fold.n, fold.text, *fold.means()])
    return _by_key(folds, keys).mapInArrow(walk, schema)


def running(df: DataFrame, keys: Sequence[str], order: str, text, arrays: dict[str, str], limit: int, width: int = WIDTH) -> DataFrame:
    """keys, the order, ``n``, ``text``, the mean of each array column up to each
    row of ``df`` (rows that fit), in the order, and its width (``<name>_cols``)."""
    n, keys = len(arrays), list(keys)
    bucket = [*keys, "_bk"]
    every, buckets = _rows(df, keys, order, text, arrays, width)
    every = every.where("_fits")
    folds = _bucket_folds(every.where("_more"), keys, n, limit)
    names = [f"_a{k}" for k in range(n)]
    schema = StructType([*_key_fields(folds, keys), StructField("_bk", LongType()), *_parse(_columns(names))])

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The fold up to the end of each bucket, on that bucket."""
        def visit(fold: Fold, batch: pa.RecordBatch, a: int, b: int) -> list:
            out = []
            for r in range(a, b):
                _merge(fold, batch, r, n, limit)
                out.append([*key_of(batch, r), batch.column("_bk")[r].as_py(), *fold.state()])
            return out

        def key_of(batch: pa.RecordBatch, r: int) -> list:
            return [batch.column(i)[r].as_py() for i in range(len(keys))]

        return _walk(len(keys), n, limit, schema, visit, None)(batches)

    ends = _by_key(folds, keys).mapInArrow(offsets, schema)
    # a bucket goes on from the last folded one before it: the one before may hold misfits alone
    state = [f"_s{k}" for k in range(n)] + [f"_c{k}" for k in range(n)]
    names_k = [f"_k{i}" for i in range(len(bucket))]
    marks = buckets.where("_later").select(*names_k, F.lit(1).alias("_ask"), F.lit(None).cast(_struct(ends, ["_n", "_text", *state])).alias("_st")).unionByName(
        ends.select(*[F.col(c).alias(k) for c, k in zip(bucket, names_k)], F.lit(0).alias("_ask"), F.struct("_n", "_text", *state).alias("_st")))
    before = Window.partitionBy(*names_k[:-1]).orderBy(names_k[-1], F.desc("_ask")).rowsBetween(Window.unboundedPreceding, -1)
    start = marks.withColumn("_st", F.when(F.col("_ask") == 1, F.last("_st", ignorenulls=True).over(before))).where("_ask = 1").drop("_ask")
    head = F.row_number().over(Window.partitionBy(*bucket).orderBy("_o")) == 1
    src = every.withColumn("_head", head).join(start, _same(bucket), "left")
    # the first row of a bucket alone carries the fold before it
    widths = [f"_q{k}" for k in range(n)]
    src = src.select(*bucket, "_o", "_t", *names, *widths, *[F.when(F.col("_head"), F.col(f"_st.{c}")).alias(c) for c in ["_n", "_text", *state]])
    src = src.sortWithinPartitions(*bucket, "_o")

    def visit(fold: Fold, batch: pa.RecordBatch, a: int, b: int) -> list:
        if batch.column("_n")[a].is_valid:
            _merge(fold, batch, a, n, limit)
        texts, orders = batch.column("_t").slice(a, b - a).to_pylist(), batch.column("_o").slice(a, b - a).to_pylist()
        key, cols = [batch.column(i)[a].as_py() for i in range(len(keys))], [batch.column(q)[a].as_py() for q in widths]
        columns = []
        for k, m in enumerate(names):
            block, has = _block(batch, m, a, b)
            if block is None:
                columns.append([fold.means()[k]] * (b - a))
                continue
            block = block if fold.sums[k] is None else np.vstack([fold.sums[k], block])
            sums = np.add.accumulate(block)
            counts = fold.counts[k] + np.cumsum(has)
            place = np.cumsum(has) - (1 if fold.sums[k] is None else 0)
            columns.append([sums[p] / c if c else None for p, c in zip(place, counts)])
            fold.sums[k], fold.counts[k] = sums[-1], int(counts[-1])
        out = []
        for r in range(b - a):
            if len(fold.text) < limit:
                fold.text = (fold.text + " " + texts[r] if fold.n else texts[r])[:limit]
            fold.n += 1
            out.append([*key, orders[r], fold.n, fold.text, *[c[r] for c in columns], *cols])
        return out

    # the bucket is part of a walk's key only to tell buckets apart
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _walk(len(bucket), n, limit, result, visit, None)(batches)

    order_field = StructField(order, df.schema[order].dataType)
    result = StructType([*_key_fields(src, keys), order_field, *_parse(", ".join(
        ["n long", "text string", *[f"`{m}` array<double>" for m in arrays], *[f"`{m}_cols` int" for m in arrays]]))])
    return src.mapInArrow(walk, result)


def _struct(df: DataFrame, columns: Sequence[str]):
    return StructType([df.schema[c] for c in columns])


def misfits(df: DataFrame, keys: Sequence[str], order: str, text, arrays: dict[str, str], width: int = WIDTH) -> DataFrame:
    """keys, the order and the text of the rows with an array of another shape
    than the first of their key."""
    rows, _ = _rows(df, keys, order, text, arrays, width)
    return rows.where("not _fits").select(*keys, F.col("_o").alias(order), F.col("_t").alias("text"))
