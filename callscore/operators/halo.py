"""Bounded-frame windows over huge keys.

A window with a fixed frame (``rowsBetween(-h, h)``, ``lag``/``lead`` up to
``h``) only needs ``h`` neighbours, yet ``partitionBy(key)`` sends a whole
key to one task. Here rows are partitioned by (key, position bucket); the
``h`` rows on each side of a bucket boundary are copied into the
neighbouring bucket as read-only "halo" rows, the window runs per bucket,
and halo rows are dropped. Results are identical for every core row, and
no task holds more than one bucket plus 2h rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BUCKET_ROWS = 1 << 16


def halo_window(df: DataFrame, keys: Sequence[str], pos: str, halo: int,
                build: Callable[[DataFrame, WindowSpec], DataFrame],
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Apply ``build(df, w)`` where ``w`` is partitioned by (keys, bucket) and
    ordered by ``pos`` (a dense 0-based integer position inside the key).

    ``build`` may only look ``halo`` rows away from the current row."""
    if halo > bucket_rows:
        raise ValueError("halo must not exceed the bucket size")
    keys = list(keys)
    b = F.floor(F.col(pos) / F.lit(bucket_rows)).cast("long")
    off = F.col(pos) - b * F.lit(bucket_rows)
    # one pass: every row emits its own bucket, plus a read-only copy for a
    # neighbouring bucket when it lies within ``halo`` of the boundary
    copies = F.array(
        F.struct(b.alias("_hb"), F.lit(False).alias("_halo"), F.lit(True).alias("_keep")),
        F.struct((b + 1).alias("_hb"), F.lit(True).alias("_halo"),
                 ((F.lit(halo) > 0) & (off >= bucket_rows - halo)).alias("_keep")),
        F.struct((b - 1).alias("_hb"), F.lit(True).alias("_halo"),
                 ((F.lit(halo) > 0) & (off < halo) & (b > 0)).alias("_keep")))
    u = df.select("*", F.inline(F.filter(copies, lambda c: c["_keep"]))).drop("_keep")
    w = Window.partitionBy(*keys, "_hb").orderBy(pos)
    return build(u, w).filter(~F.col("_halo")).drop("_hb", "_halo")
