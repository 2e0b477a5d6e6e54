"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callscore.llm import negatives
from callscore.llm.negatives import RTree

from .helpers import empty

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5):
    kept = [(i, [math.floor(256 * x) for x in v], la) for i, v, la in rows
            if la is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, v, la) in enumerate(kept):
        if i is None or i % 100:
            continue
        others = [(dot(v, w), j, lb) for m, (j, w, lb) in enumerate(kept) if m != n]
        for score, j, _ in sorted((o for o in others if o[2] == la), key=order)[:positives]:
            fits = sorted((o for o in others if o[2] != la and 80 * score <= 100 * o[0] <= 100 * score), key=order)[:negatives]
            out += [(i, j, rank, k, score, other) for rank, (other, k, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def run(df, **more):
    return sorted([tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **more).collect()], key=str)


def rows_of(seed, n, dim, labels=3, spread=0.3):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(dim)] for _ in range(4)]
    near = lambda c: [float(np.float32(x + r.uniform(-spread, spread))) for x in c]
    return [(i * 10, near(r.choice(centres)), r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("tile_rows", [16, 4096])
def test_brute_force_with_copies_and_odd_rows(spark, tile_rows):
    """A third of the rows are one vector, an anchor is repeated, others are left out or short."""
    rows = rows_of(1, 120, 6)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(60)] + [rows[10], rows[10], (None, rows[3][1], 1), (None, rows[3][1], 2)]
    rows += [(5000, None, 1), (5100, [1.0, None, 0.0], 1), (5200, [float("nan")] * 6, 1), (5300, [float("inf")] * 6, 2), (5400, rows[5][1], None),
             (5500, [], 1), (5600, [0.5, -0.25], 2), (5700, [0.0] * 6, 0), (-100, rows[7][1], 1), (5800, [0.25] * 9, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows)
    assert len(expected) > 200 and run(df, tile_rows=tile_rows) == expected


def test_few_rows(spark):
    """Fewer positives or negatives than asked, negative scores, none at all, and clashing names."""
    rows = [(100, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [-1.0, 0.0], 1), (3, [0.4, 9.0], 2), (4, [0.5, 1.0], 2), (200, [0.0, 1.0], 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df) == brute(rows) == [(100, 1, 1, 4, 256 * 128, 256 * 128)]
    more = df
    for c in ("id", "row", "tile", "query", "rank", "windows", "anchor_id", "score"):
        more = more.withColumn(c, F.lit("clash"))
    assert run(more) == brute(rows)
    assert run(empty(df)) == run(df.where("vec_id <> 100 and vec_id <> 200")) == run(df.withColumn("label", F.lit(1))) == []


def test_large_components_stay_exact(spark):
    rows = [(100, [3e6, 1.0], 1), (1, [3e6, 1.0], 1), (2, [3e6, 0.99609375], 2), (3, [3e6, 1.00390625], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = run(df)
    assert got == brute(rows) and [r[3] for r in got] == [2] and got[0][4] - got[0][5] == 256


def test_tree_prunes_and_finds_the_same(spark):
    r = np.random.default_rng(3)
    centres = r.integers(-200, 200, (40, 8))
    vectors = (centres[r.integers(0, 40, 4000)] + r.integers(-3, 4, (4000, 8))).astype(float)
    labels, ids = r.integers(0, 4, 4000), r.permutation(4000)
    tree = RTree(vectors, labels, ids, np.zeros(4000, bool), leaf_rows=16)
    leaves = [run for children, run in zip(tree.children, tree.runs) if not children]
    assert [a for a, _ in leaves[1:]] == [b for _, b in leaves[:-1]] and leaves[0][0] == 0 and leaves[-1][1] == 4000
    assert sorted(tree.ids.tolist()) == list(range(4000)) and max(b - a for a, b in leaves) == 16
    queries, asked = vectors[:20], [[(-(1 << 63), (1 << 63) - 1), (0, int((vectors @ q).max() * 0.9)), (5, 4)] for q in vectors[:20]]
    seen = []
    tree.runs = type("Counted", (), {"__getitem__": lambda _, n, runs=tree.runs: (seen.append(n), runs[n])[1]})()
    for q, label, windows, found in zip(queries, labels.tolist(), asked, tree.search(queries, labels[:20].tolist(), False, asked, 5)):
        for (lo, hi), got in zip(windows, found):
            fits = sorted((-s, False, i) for s, i, la in zip((vectors @ q).astype(int).tolist(), ids.tolist(), labels.tolist()) if la != label and lo <= s <= hi)
            assert got == fits[:5]
        low, high = negatives.bounds(tree.low, tree.high, q[None, :])
        for n, (a, b) in enumerate(leaves):
            node = [i for i, c in enumerate(tree.children) if not c][n]
            assert low[0, node] <= (tree.vectors[a:b] @ q).min() and (tree.vectors[a:b] @ q).max() <= high[0, node]
    assert len(seen) < 20 * len(leaves) / 2
