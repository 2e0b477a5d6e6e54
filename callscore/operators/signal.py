"""Framed-signal operators (W6-W10): rolling voiced count, delta and
delta-delta features with edge handling, adaptive width, silence trim.

All windows have a bounded frame and run through ``halo_window``; series
lengths come from a grouped count. Nothing collects a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .halo import halo_window

# ---- fixed values ----
RING = 10            # voice-detector ring size
DELTA_WIDTH = 9
TRIM_TOP_DB = 30.0
WIDTHS = (3, 5, 7, 9)


def delta_coefficients(width: int, order: int) -> list[float]:
    """Weights of the centred least-squares derivative of degree ``order``
    (slope for 1, second derivative of the local quadratic for 2)."""
    h = (width - 1) // 2
    ks = list(range(-h, h + 1))
    if order == 1:
        den = sum(k * k for k in ks)
        return [k / den for k in ks]
    if order == 2:
        m = sum(k * k for k in ks) / width
        den = sum((k * k - m) ** 2 for k in ks)
        return [2 * (k * k - m) / den for k in ks]
    raise ValueError("order must be 1 or 2")


def rolling_voiced(frames: DataFrame, keys: Sequence[str] = ("clip_id",), pos: str = "frame_no",
                   flag: str = "is_voiced", ring: int = RING) -> DataFrame:
    """Voiced frames among the last ``ring`` frames (current included); a
    null flag is unvoiced."""
    def build(df, w):
        return df.withColumn("n_voiced", F.sum(F.coalesce(F.col(flag).cast("long"), F.lit(0))).over(w.rowsBetween(-(ring - 1), 0)))
    return halo_window(frames, keys, pos, ring - 1, build)


def _offsets(w, x: str, halo: int) -> Column:
    vals = [F.lag(x, -o).over(w) if o < 0 else (F.col(x) if o == 0 else F.lead(x, o).over(w))
            for o in range(-halo, halo + 1)]
    return F.array(*vals)


def _delta_expr(arr: str, halo: int, t: Column, n: Column, width: int, order: int) -> Column:
    h = (width - 1) // 2
    s = F.least(F.greatest(t, F.lit(h)), n - 1 - h) - t
    acc = None
    for k, c in zip(range(-h, h + 1), delta_coefficients(width, order)):
        term = F.lit(c) * F.element_at(F.col(arr), (s + F.lit(k + halo + 1)).cast("int"))
        acc = term if acc is None else acc + term
    return F.when(n >= width, acc).otherwise(F.lit(0.0))


def with_series_length(df: DataFrame, keys: Sequence[str], out: str = "_n") -> DataFrame:
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return df.join(n, list(keys))


def delta(df: DataFrame, keys: Sequence[str], pos: str, x: str, width: int = DELTA_WIDTH, order: int = 1,
          out: str = "delta") -> DataFrame:
    """Savgol-style derivative of ``x`` along ``pos`` (dense 0-based);
    edge rows reuse the first/last full window; series shorter than the
    width give 0."""
    h = (width - 1) // 2
    d = with_series_length(df, keys)

    def build(u, w):
        u = u.withColumn("_x", _offsets(w, x, 2 * h))
        return u.withColumn(out, _delta_expr("_x", 2 * h, F.col(pos), F.col("_n"), width, order)).drop("_x")
    return halo_window(d, keys, pos, 2 * h, build).drop("_n")


def adaptive_width(n: Column) -> Column:
    """min(9, max(3, 2 * (n // 2) + 1))."""
    return F.least(F.lit(9), F.greatest(F.lit(3), F.floor(n / 2).cast("int") * 2 + 1))


def delta_adaptive(df: DataFrame, keys: Sequence[str], pos: str, x: str, order: int = 1,
                   out: str = "delta") -> DataFrame:
    """W9 + W7/W8: width chosen per series from its length; a width longer
    than the series gives zeros (the reference's failure fallback)."""
    halo = (max(WIDTHS) - 1)
    d = with_series_length(df, keys).withColumn("width", adaptive_width(F.col("_n")))

    def build(u, w):
        u = u.withColumn("_x", _offsets(w, x, halo))
        expr = F.lit(0.0)
        for wd in WIDTHS:
            expr = F.when(F.col("width") == wd, _delta_expr("_x", halo, F.col(pos), F.col("_n"), wd, order)) \
                .otherwise(expr)
        return u.withColumn(out, expr).drop("_x")
    return halo_window(d, keys, pos, halo, build).drop("_n")


def silence_trim(frames: DataFrame, keys: Sequence[str] = ("clip_id",), pos: str = "frame_no", db: str = "db",
                 top_db: float = TRIM_TOP_DB) -> DataFrame:
    """Keep the frames from the first to the last frame louder than
    (max - top_db) of their clip."""
    keys = list(keys)
    mx = frames.groupBy(*keys).agg(F.max(db).alias("_mx"))
    j = frames.join(mx, keys)
    loud = F.col(db) > F.col("_mx") - F.lit(top_db)
    rng = j.groupBy(*keys).agg(F.min(F.when(loud, F.col(pos))).alias("_lo"), F.max(F.when(loud, F.col(pos))).alias("_hi"))
    k = frames.join(rng, keys)
    return k.filter((F.col(pos) >= F.col("_lo")) & (F.col(pos) <= F.col("_hi"))).drop("_lo", "_hi")
