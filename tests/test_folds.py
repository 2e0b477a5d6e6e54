"""Array folds against a plain fold in order, and batch against stream."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callscore.operators import calls, folds, matrices
from callscore.streaming.calls import CallState, Fold

CHUNK = "call_id string, chunk_index int, transcript string, mfcc array<array<double>>, spectrogram array<array<double>>"


def _matrix(rng, shapes):
    rows, cols = rng.choice(shapes)
    return [[rng.randint(-9, 9) / 4 for _ in range(cols)] for _ in range(rows)]


def _chunks(seed, n_calls=6, n=60):
    """Chunks of two shapes (4 x 2 and 2 x 4 have the same size), without a matrix, repeated as they are or as others."""
    rng, rows = random.Random(seed), []
    for c in range(n_calls):
        usual = [(4, 2)] * 20 + [(2, 4), (3, 2)]
        for i in rng.sample(range(3 * n), n):
            m = None if rng.random() < 0.2 else [] if rng.random() < 0.1 else _matrix(rng, usual)
            s = None if rng.random() < 0.4 else _matrix(rng, [(1, 3)] * 10 + [(3, 1)])
            rows.append((None if c == 0 else f"c{c}", i, rng.choice([None, "", " a ", "bb", "ccc", "d" * 90]), m, s))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


def _fold_in_order(rows):
    """call -> its fold, the rows (index, n, text, means) that count and the indexes that do not."""
    out = {}
    for call in {r[0] for r in rows}:
        fold, running, misfits = Fold(), [], []
        by_index = {r[1]: r for r in rows if r[0] == call}
        for i in sorted(by_index):
            _, _, text, m, s = by_index[i]
            flat = lambda x: (None, None) if not x else ([v for row in x for v in row], len(x[0]))
            if fold.add(((text or "").strip(), *flat(m), *flat(s))):
                running.append((i, fold.n, fold.text[:512], *fold.matrices()[::2]))
            else:
                misfits.append(i)
        out[call] = (fold, running, misfits)
    return out


def _same(a, b):
    return a is None and b is None or a is not None and b is not None and np.allclose(a, b, rtol=0, atol=1e-12) and len(a) == len(b)


@pytest.mark.parametrize("seed,width,batch", [(1, 4096, 10000), (2, 16, 7), (3, 1, 10000), (4, 50, 3)])
def test_folds_equal_a_fold_in_order(spark, seed, width, batch):
    rows = _chunks(seed)
    want = _fold_in_order(rows)
    df = spark.createDataFrame(rows, CHUNK).repartition(5)
    text, arrays = F.trim(F.coalesce("transcript", F.lit(""))), {"mfcc": "mfcc", "spectrogram": "spectrogram"}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        final = {r["call_id"]: r for r in folds.final(df, ["call_id"], "chunk_index", text, arrays, 2048, width).collect()}
        running = folds.running(df, ["call_id"], "chunk_index", text, arrays, 512, width).collect()
        misfits = folds.misfits(df, ["call_id"], "chunk_index", text, arrays, width).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert set(final) == set(want) and any(w[2] for w in want.values())
    for call, (fold, steps, bad) in want.items():
        r = final[call]
        assert (r["n"], r["text"]) == (fold.n, fold.text)
        assert _same(r["mfcc"], fold.matrices()[0]) and _same(r["spectrogram"], fold.matrices()[2])
        got = sorted((x for x in running if x["call_id"] == call), key=lambda x: x["chunk_index"])
        assert [(x["chunk_index"], x["n"], x["text"]) for x in got] == [s[:3] for s in steps]
        assert all(_same(x["mfcc"], s[3]) and _same(x["spectrogram"], s[4]) for x, s in zip(got, steps))
        assert sorted(x["chunk_index"] for x in misfits if x["call_id"] == call) == bad


def test_batch_and_stream_have_one_rule_for_shapes(spark):
    rows = [r for r in _chunks(5) if r[0] is not None]
    df = spark.createDataFrame(rows, CHUNK)
    final = {r["call_id"]: r for r in calls.call_final(df).collect()}
    running = {(r["call_id"], r["chunk_index"]): r for r in calls.call_running(df).collect()}
    changed = {(r["call_id"], r["chunk_index"]) for r in calls.changed_shapes(df).collect()}

    class Waiting(dict):
        updateValue, getValue, removeKey = dict.__setitem__, dict.__getitem__, dict.pop

    shown, quarantined = {}, set()
    for call in final:
        state = CallState(call, Waiting())
        for _, i, text, m, s in (r for r in rows if r[0] == call):
            flat = lambda x: (None, None) if not x else ([v for row in x for v in row], len(x[0]))
            state.take([(i, ((text or "").strip(), *flat(m), *flat(s)))])
        state.close("final")
        last = {}
        for row in state.out:       # (kind, call, index, n, text, ...)
            last[row[2]] = row
        assert (last[None][3], last[None][4]) == (final[call]["n_segments"], final[call]["full_text"])
        shown |= {(call, i): (r[3], r[4]) for i, r in last.items() if r[0] == "running"}
        quarantined |= {(call, i) for i, r in last.items() if r[0] == "quarantined"}
    assert changed == quarantined and changed
    assert {k: (r["n_segments"], r["running_text"]) for k, r in running.items()} == shown


def test_a_delivery_counts_whole_and_sets_the_shape(spark):
    two, one = [[1.0, 2.0]], [[5.0]]
    rows = [("a", 0, "x", None, None), ("a", 0, "y", two, None), ("a", 1, "z", one, None), ("a", 2, "w", two, None)]
    got = calls.call_final(spark.createDataFrame(rows, CHUNK)).first()
    assert (got["n_segments"], got["full_text"]) == (2, "x z")


def test_a_call_whose_last_chunks_do_not_fit_and_an_empty_table(spark):
    rows = [("a", i, "x", [[1.0, 2.0]] if i < 5 else [[1.0]], None) for i in range(12)]
    df = spark.createDataFrame(rows, CHUNK)
    got = sorted((r["chunk_index"], r["n_segments"]) for r in calls.call_running(df, bucket_width=2).collect())
    assert got == [(i, i + 1) for i in range(5)]
    assert calls.call_running(df.limit(0)).count() == 0 and calls.call_final(df.limit(0)).count() == 0


def test_buckets_without_a_row_that_fits_hand_the_fold_on(spark):
    rows = [("a", i, "x", [[float(i)]] if i < 4 or i > 9 else [[1.0, 2.0]], None) for i in range(14)]
    df = spark.createDataFrame(rows, CHUNK)
    got = {r["chunk_index"]: (r["n"], r["mfcc"]) for r in folds.running(df, ["call_id"], "chunk_index", F.col("transcript"), {"mfcc": "mfcc"}, 512, 2).collect()}
    assert got[10] == (5, [16 / 5]) and got[13] == (8, [52 / 8]) and len(got) == 8


def test_arrays_are_shuffled_whole(spark):
    df = spark.createDataFrame(_chunks(6), CHUNK)
    plan = calls.call_running(df)._jdf.queryExecution().toString()
    assert "posexplode" not in plan.lower() and "explode" not in plan.lower()


def test_running_cells(spark):
    df = spark.createDataFrame([("a", i, [[float(i), 1.0], [2.0, 3.0 * i]]) for i in range(9)], "k string, i long, m array<array<double>>")
    got = {(r["i0"], r["i"], r["j"]): r["v"] for r in matrices.running_elementwise_mean(
        df.withColumnRenamed("i", "i0"), ["k"], "i0", "m", bucket_width=4).collect()}
    assert got[8, 0, 0] == 4.0 and got[8, 1, 1] == 12.0 and got[3, 1, 0] == 2.0 and len(got) == 36
