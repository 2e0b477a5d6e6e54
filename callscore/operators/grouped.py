"""Grouped Python logic with per-partition batching.

``groupBy(k).applyInPandas(f)`` pays a fixed cost per group. For many small
groups (clips, buckets) the same result comes from hash-partitioning by the
key, sorting inside each partition, and walking the contiguous groups of
every Arrow batch in one ``mapInPandas`` call. A group that straddles two
batches is carried over, so each group is still seen whole (groups must be
bounded in size, as the callers guarantee).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def _starts(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Row numbers at which a group begins (the first row included); nulls are
    one key."""
    new = np.zeros(len(pdf), bool)
    new[0] = True
    for k in keys:
        col, null = pdf[k], pdf[k].isna().to_numpy()
        differs = (col.to_numpy()[1:] != col.to_numpy()[:-1]) & ~(null[1:] & null[:-1])
        new[1:] |= differs.astype(bool)
    return np.flatnonzero(new)


def _key(pdf: pd.DataFrame, keys: list[str], row: int) -> tuple:
    return tuple(None if pd.isna(v) else v for v in (pdf[k].iloc[row] for k in keys))


def map_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
               schema: str) -> DataFrame:
    keys = list(keys)

    def run(it):
        held, held_key = [], None       # parts of the group that may go on in the next batch
        for pdf in it:
            if pdf.empty:
                continue
            starts = _starts(pdf, keys).tolist()
            outs = []
            for a, b in zip(starts, [*starts[1:], len(pdf)]):
                key = _key(pdf, keys, a) if a == 0 or b == len(pdf) else None
                if a == 0 and held and key != held_key:
                    outs.append(fn(pd.concat(held, ignore_index=True)))
                    held = []
                part = pdf.iloc[a:b]
                if b == len(pdf):
                    held.append(part)
                    held_key = key
                elif a == 0 and held:
                    outs.append(fn(pd.concat([*held, part], ignore_index=True)))
                    held = []
                else:
                    outs.append(fn(part.reset_index(drop=True)))
            outs = [o for o in outs if len(o)]
            if outs:
                yield pd.concat(outs, ignore_index=True)
        if held:
            out = fn(pd.concat(held, ignore_index=True))
            if len(out):
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
