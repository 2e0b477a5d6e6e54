"""Element-wise matrix aggregates.

For the mean, matrices are exploded to (i, j, v) cells inside the same stage
and summed with a grouped aggregate, so the map side already reduces every key
to one partial sum per cell: a hot key costs one cell table, not its rows. The
running form folds whole arrays (``folds``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import folds


def explode_cells(df: DataFrame, keep: Sequence[str], m: str) -> DataFrame:
    x = df.select(*keep, F.posexplode(m).alias("i", "_row"))
    return x.select(*keep, "i", F.posexplode("_row").alias("j", "v"))


def assemble(cells: DataFrame, keys: Sequence[str], out: str = "m") -> DataFrame:
    """(keys, i, j, v) back to one matrix per key (bounded by the matrix size)."""
    rows = cells.groupBy(*keys, "i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("_r"))
    rows = rows.select(*keys, "i", F.transform("_r", lambda s: s["v"]).alias("_row"))
    m = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "_row"))).alias("_m"))
    return m.select(*keys, F.transform("_m", lambda s: s["_row"]).alias(out))


def elementwise_mean(df: DataFrame, keys: Sequence[str], m: str) -> DataFrame:
    """A1: mean matrix per key, as cells (keys, i, j, v)."""
    c = explode_cells(df, list(keys), m)
    return c.groupBy(*keys, "i", "j").agg(F.avg("v").alias("v"))


def running_elementwise_mean(df: DataFrame, keys: Sequence[str], order: str, m: str,
                             bucket_width: int = folds.WIDTH) -> DataFrame:
    """Per key in ``order``, the mean of all matrices so far, as cells. Matrices
    are shuffled whole; they become cells after the last shuffle."""
    src = df.where(F.size(F.flatten(m)) > 0)
    r = folds.running(src, keys, order, F.lit(""), {"_m": m}, 0, bucket_width)
    cells = r.select(order, *keys, "_m_cols", F.posexplode("_m").alias("_p", "v"))
    return cells.select(order, *keys, F.floor(F.col("_p") / F.col("_m_cols")).cast("int").alias("i"), (F.col("_p") % F.col("_m_cols")).alias("j"), "v")
