"""Skew-safe running totals and ranks, one plan for every size.

``row_number()`` or a running ``sum`` over ``partitionBy(key).orderBy(o)``
puts every row of a key into one task. When one key can hold a third of
the table that task is the job. The helpers here compute the same numbers
in two levels:

1. rows are tagged with a bucket that is monotone in the order inside the
   key (an integer range of the order value, an hour, leading hash digits), so
   a (key, bucket) group is bounded however large the key is;
2. per (key, bucket) totals form a small table, made with partial sums
   before any shuffle; a window over it gives each bucket the total of all
   earlier buckets of its key;
3. the totals are joined back on (key, bucket), and a window over the same
   (key, bucket), which needs no further shuffle, finishes the local running
   value.

Nothing is counted while a query is being built, and no switch looks at the
size of the data. Null keys are a key, and null order values come first, as in
a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColLike = str | Column

_FIRST = -(1 << 63)     # the bucket of null order values
_FAR = 1e12             # scores beyond are in the outermost buckets


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def running_totals(df: DataFrame, part: Sequence[str], order: Sequence[ColLike], bucket: Column,
                   sums: dict[str, Column] | None = None, rank: str | None = None,
                   count: str | None = None, across: bool = False) -> DataFrame:
    """Add running columns over ``order`` inside ``part``.

    ``sums``  name -> numeric column: inclusive running sum (current row included).
    ``rank``  name for the 0-based ``row_number`` (ties broken by ``order``; the
              caller supplies a total order).
    ``count`` name for the number of rows of the key (the group size).
    ``bucket`` must be non-decreasing in ``order`` within each key (null for a
              null order value).
    ``across`` lets rank and sums go on from key to key, in the order of
              ``part``; the (key, bucket) totals then meet in one window.
    """
    sums = dict(sums or {})
    part = list(part)
    # null-free text forms of the keys, so that one plain equality serves the
    # join, the aggregate and the windows alike
    keys = [f"_k{i}" for i in range(len(part))]
    b = df.withColumn("_bk", F.coalesce(bucket.cast("long"), F.lit(_FIRST)))
    for k, c in zip(keys, part):
        b = b.withColumn(k, F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")))
    for k, c in sums.items():
        b = b.withColumn(f"_v_{k}", c)
    aggs = [F.count(F.lit(1)).alias("_t__n")] + [F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums]
    aggs += [F.min(c).alias(f"_p{i}") for i, c in enumerate(part) if across]
    tot = b.groupBy(*keys, "_bk").agg(*aggs)
    if across:      # one row per (key, bucket), in the order of the keys
        wb = Window.orderBy(*[f"_p{i}" for i in range(len(part))], "_bk")
    else:
        wb = Window.partitionBy(*keys).orderBy("_bk") if keys else Window.orderBy("_bk")
    wprev = wb.rowsBetween(Window.unboundedPreceding, -1)
    names = ["_n", *sums]
    offs = tot.select(
        *keys, "_bk",
        *[F.coalesce(F.sum(f"_t_{k}").over(wprev), F.lit(0)).alias(f"_o_{k}") for k in names],
        *([F.sum("_t__n").over(wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
           .alias(count)] if count else []),
    )
    j = b.join(offs, [*keys, "_bk"])
    wl = Window.partitionBy(*keys, "_bk").orderBy(*[_c(o) for o in order])
    out = j
    if rank:
        out = out.withColumn(rank, F.col("_o__n") + F.row_number().over(wl) - F.lit(1))
    wr = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k in sums:
        out = out.withColumn(k, F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(wr))
    return out.drop("_bk", *keys, *[f"_v_{k}" for k in sums], *[f"_o_{k}" for k in names])


def int_bucket(order_col: ColLike, width: int) -> Column:
    """Bucket for an integer order key (chunk index, frame number, id)."""
    return F.floor(_c(order_col) / F.lit(width)).cast("long")


def hash_bucket(hex_col: ColLike, digits: int = 3) -> Column:
    """Bucket from the leading hex digits of an md5 order key (uniform)."""
    return F.conv(F.substring(_c(hex_col), 1, digits), 16, 10).cast("long")


def time_bucket(ts: ColLike, seconds: int = 3600) -> Column:
    """Bucket for a timestamp order key."""
    return F.floor(F.unix_micros(_c(ts).cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def score_bucket(p: ColLike, per_unit: int = 4096) -> Column:
    """Bucket for a score, ``per_unit`` to a distance of 1 (probabilities: that
    many in all). Not-a-number sorts last, as in a window."""
    x = F.nanvl(_c(p).cast("double"), F.lit(_FAR))
    return F.floor(F.least(F.greatest(x, F.lit(-_FAR)), F.lit(_FAR)) * F.lit(per_unit)).cast("long")
