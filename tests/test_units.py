"""Hand-made edge cases (FIXTURES section 6) and operator properties."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callscore.functions import arrays as A
from callscore.functions.scoring import decide, stand_in_text_prob, status
from callscore.operators import calls, cleaning, metrics, segments, signal, splits
from callscore.operators.halo import halo_window
from callscore.operators.prefix import int_bucket, running_totals, score_bucket


def test_ring_six_of_ten_stays_idle_seven_opens():
    six = [1] * 6 + [0] * 4
    assert segments.sessionise(list(range(10)), six, flush_open=True) == []
    m = segments.VadMachine()
    for p, v in enumerate([0, 0, 0] + [1] * 7):
        m.step(p, v)
    assert m.open and m.f0 == 0


def test_segment_closes_with_trailing_silence_and_ring_kept():
    flags = [1] * 10 + [0] * 7 + [1] * 3
    segs = segments.sessionise(list(range(len(flags))), flags)
    # opens at frame 6 with 7 ring frames (f0 = 0), closes when 7 unvoiced are in the ring
    assert segs == [(0, 16, 17)]


def test_empty_pieces_keep_double_space(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, ""), (1, 2, "b")], "call_id long, chunk_index int, transcript string")
    assert calls.final_text(df).first()["full_text"] == "a  b"


def test_null_and_whitespace_pieces(spark):
    df = spark.createDataFrame([(1, 0, "  x \n"), (1, 1, None), (1, 2, "　y")],
                               "call_id long, chunk_index int, transcript string")
    assert calls.final_text(df).first()["full_text"] == "x  y"


@pytest.mark.parametrize("limit,n", [(512, 513), (2048, 2049)])
def test_text_cut(spark, limit, n):
    df = spark.createDataFrame([(1, 0, "a" * (n - 2)), (1, 1, "b")], "call_id long, chunk_index int, transcript string")
    txt = calls.final_text(df, limit).first()["full_text"]
    assert len(txt) == limit and txt == ("a" * (n - 2) + " b")[:limit]


def test_running_text_tail_rows_keep_settled_prefix(spark):
    rows = [(1, i, "w" * 100) for i in range(12)]
    df = spark.createDataFrame(rows, "call_id long, chunk_index int, transcript string")
    got = {r["chunk_index"]: r["running_text"] for r in calls.running_text(df).collect()}
    full = " ".join("w" * 100 for _ in range(12))
    for i in range(12):
        assert got[i] == " ".join("w" * 100 for _ in range(i + 1))[:512]
    assert got[11] == full[:512]


def test_threshold_strict_and_inclusive(spark):
    df = spark.createDataFrame([(0.5,)], "p double")
    r = df.select(status("p").alias("s"), decide("p", inclusive=True).alias("i"), decide("p").alias("x")).first()
    assert r["s"] == "Normal" and r["i"] == 1 and r["x"] == 0


def test_short_text_prior_offline_vs_live(spark):
    df = spark.createDataFrame([(" ab ",)], "t string")
    r = df.select(stand_in_text_prob("t", 3).alias("off"), stand_in_text_prob("t", 2).alias("live")).first()
    assert r["off"] == 0.5 and r["live"] == pytest.approx(0.04)


def test_peak_normalize_silent_and_clamped(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.01, -0.005],), ([],)], "y array<double>")
    out = [r[0] for r in df.select(A.peak_normalize("y")).collect()]
    assert out[0] == [0.0, 0.0] and out[1] == pytest.approx([0.1, -0.05]) and out[2] == []


def test_minmax_constant_matrix_is_zero(spark):
    df = spark.createDataFrame([([[3.0, 3.0], [3.0, 3.0]],)], "m array<array<double>>")
    assert df.select(A.minmax_normalize("m")).first()[0] == [[0.0, 0.0], [0.0, 0.0]]


def test_transpose_twice_identity_and_pad_length(spark):
    df = spark.createDataFrame([([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]],)], "m array<array<double>>")
    r = df.select(A.transpose(A.transpose("m")).alias("t"), A.pad_or_cut_rows("m", 5).alias("p"),
                  A.pad_or_cut_rows("m", 1).alias("c")).first()
    assert r["t"] == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    assert len(r["p"]) == 5 and r["p"][4] == [0.0, 0.0, 0.0] and r["c"] == [[1.0, 2.0, 3.0]]


def test_resize_identity_and_upsample(spark):
    df = spark.createDataFrame([([[0.0, 2.0], [4.0, 6.0]],)], "m array<array<double>>")
    r = df.select(A.resize("m", 2, 2).alias("same"), A.resize("m", 4, 4).alias("up")).first()
    assert r["same"] == [[0.0, 2.0], [4.0, 6.0]]
    # half-pixel centres: first output row/col equals the first input row/col
    assert r["up"][0] == pytest.approx([0.0, 0.5, 1.5, 2.0])


def test_auc_single_class_is_null_and_symmetric(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, p double")
    assert metrics.roc_auc(one, "y", "p").first()["auc"] is None
    df = spark.range(200).select((F.col("id") % 3 == 0).cast("int").alias("y"),
                                 ((F.col("id") * 37) % 11 / 10.0).alias("p"))
    a = metrics.roc_auc(df, "y", "p").first()["auc"]
    b = metrics.roc_auc(df.withColumn("p", 1 - F.col("p")), "y", "p").first()["auc"]
    assert a + b == pytest.approx(1.0)


def test_auc_matches_pairwise_definition(spark):
    rows = [((i * 7) % 3 == 0, round(((i * 13) % 17) / 17, 3)) for i in range(120)]
    df = spark.createDataFrame([(int(y), p) for y, p in rows], "y int, p double")
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = metrics.roc_auc(df, "y", "p").first()["auc"]
    assert got == pytest.approx(want)


def test_duration_gate_cases(spark):
    df = spark.createDataFrame([(1, 0.49), (2, 0.5), (3, 30.0), (4, 31.0)], "id int, duration_sec double")
    got = {r["id"]: r["duration_sec"] for r in cleaning.duration_gate(df).collect()}
    assert got == {2: 0.5, 3: 30.0, 4: 30.0}


def test_two_level_prefix_equals_window(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), "id", ((F.col("id") * 7) % 5).alias("v"))
    got = running_totals(df, ["k"], ["id"], int_bucket("id", 17), sums={"s": F.col("v")}, rank="r", count="n")
    w = Window.partitionBy("k").orderBy("id")
    want = df.select("k", "id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                     (F.row_number().over(w) - 1).alias("r"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"))
    a = sorted(tuple(r) for r in got.select("k", "id", "s", "r", "n").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_halo_window_equals_plain_window(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") / 2).cast("long").alias("pos"),
                                 ((F.col("id") * 11) % 7).cast("double").alias("x"))

    def build(d, w):
        return d.withColumn("s", F.sum("x").over(w.rowsBetween(-3, 2))).withColumn("l", F.lead("x", 2).over(w))
    got = halo_window(df, ["k"], "pos", 3, build, bucket_rows=10)
    want = build(df, Window.partitionBy("k").orderBy("pos"))
    cols = ["k", "pos", "s", "l"]
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(tuple(r) for r in want.select(cols).collect())


def test_delta_edges_reuse_full_window(spark):
    xs = [float(i * i) for i in range(12)]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(xs)], "c long, t long, x double")
    got = {r["t"]: r["delta"] for r in signal.delta(df, ["c"], "t", "x").collect()}
    slope = lambda c: sum(k * xs[c + k] for k in range(-4, 5)) / 60.0
    for t in range(12):
        assert got[t] == pytest.approx(slope(min(max(t, 4), 7)))
    short = spark.createDataFrame([(2, i, 1.0) for i in range(5)], "c long, t long, x double")
    assert {r["delta"] for r in signal.delta(short, ["c"], "t", "x").collect()} == {0.0}


def test_sessioniser_bucketed_equals_sequential(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for clip in range(4):
        v = 0
        for i in range(300):
            if rnd.random() < 0.15:
                v = 1 - v
            rows.append((clip, i, bool(v)))
    df = spark.createDataFrame(rows, "clip_id long, frame_no long, is_voiced boolean")
    want = []
    for clip in range(4):
        fl = [int(r[2]) for r in rows if r[0] == clip]
        want += [(clip, i, *s) for i, s in enumerate(segments.sessionise(list(range(300)), fl))]
    for bw in (7, 13, 64, 1 << 16):
        got = sorted(tuple(r) for r in segments.voice_segments(df, bucket_frames=bw).collect())
        assert got == sorted(want)
    flushed = []
    for clip in range(4):
        fl = [int(r[2]) for r in rows if r[0] == clip]
        flushed += [(clip, i, *s) for i, s in enumerate(segments.sessionise(list(range(300)), fl, flush_open=True))]
    for bw in (13, 1 << 16):
        got = sorted(tuple(r) for r in segments.voice_segments(df, bucket_frames=bw, flush_open=True).collect())
        assert got == sorted(flushed)


def test_split_and_folds_invariants(spark):
    df = spark.range(1003).select(F.col("id").alias("clip_id"), (F.col("id") % 3 == 0).cast("int").alias("label_num"))
    sp = splits.stratified_split(df).collect()
    assert len(sp) == 1003 and len({r["clip_id"] for r in sp}) == 1003
    for c in (0, 1):
        n = sum(1 for r in sp if r["label_num"] == c)
        test = sum(1 for r in sp if r["label_num"] == c and r["split"] == "test")
        tmp = sum(1 for r in sp if r["label_num"] == c and r["split"] != "train")
        assert tmp == math.ceil(n / 4) and test == math.ceil(tmp * 2 / 5)
    folds = splits.kfold(df).groupBy("fold").count().collect()
    sizes = [r["count"] for r in folds]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_class_report_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, pred int")
    rep = {r["row"]: r for r in metrics.class_report(df, "y", F.col("pred")).collect()}
    assert rep["Fraudulent"]["recall"] == 0.5 and rep["Non_Fraudulent"]["precision"] == pytest.approx(2 / 3)
    assert rep["accuracy"]["support"] == 0.75 and rep["macro avg"]["support"] == 4.0


@pytest.mark.parametrize("width", [1, 13, 1 << 20])
def test_prefix_keeps_null_keys_and_null_orders(spark, width):
    # key 0 holds a third of the rows; null keys, null order values, ties in the bucket value
    df = spark.range(1200).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 10).alias("k"), "id",
        F.when(F.col("id") % 20 != 7, (F.col("id") / 7).cast("long")).alias("t"), (F.col("id") % 5).alias("v"))
    got = running_totals(df, ["k"], ["t", "id"], int_bucket("t", width), sums={"s": F.col("v")}, rank="r", count="n")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("k", "id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                     (F.row_number().over(w) - 1).alias("r"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"))
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    a = sorted((tuple(r) for r in got.select("k", "id", "s", "r", "n").collect()), key=key)
    assert len(a) == 1200 and a == sorted((tuple(r) for r in want.collect()), key=key)


def test_prefix_without_a_key(spark):
    df = spark.range(300).select("id", ((F.col("id") * 17) % 101).cast("double").alias("p"))
    got = running_totals(df, [], ["p", "id"], score_bucket("p", 1), rank="r")
    want = df.select("id", (F.row_number().over(Window.orderBy("p", "id")) - 1).alias("r"))
    assert sorted(tuple(r) for r in got.select("id", "r").collect()) == sorted(tuple(r) for r in want.collect())


@pytest.mark.parametrize("digits", [1, 3])
def test_folds_equal_one_global_numbering(spark, digits):
    df = spark.range(700).select(F.col("id").alias("clip_id"),
                                 F.when(F.col("id") % 60 != 0, (F.col("id") % 4 == 0).cast("int")).alias("label_num"))
    got = splits.kfold(df, digits=digits)
    w = Window.orderBy("label_num", "_h", "clip_id")
    want = df.withColumn("_h", splits.hash_key("clip_id")).select(
        "clip_id", "label_num", ((F.row_number().over(w) - 1) % 5).cast("int").alias("fold"))
    key = lambda r: r[0]
    a = sorted((tuple(r) for r in got.select("clip_id", "label_num", "fold").collect()), key=key)
    assert len(a) == 700 and a == sorted((tuple(r) for r in want.collect()), key=key)


def test_auc_over_buckets_equals_pairs(spark):
    import random
    rng = random.Random(11)
    rows = [(g, int(rng.random() < 0.4), rng.choice([rng.random(), 0.5, rng.random() * 8 - 4])) for g in (1, 2) for _ in range(150)]
    rows += [(3, 1, 0.2), (3, 1, 0.4), (None, 1, 0.9), (None, 0, 0.1), (None, 0, 0.9)]
    df = spark.createDataFrame(rows, "g int, y int, p double")
    got = {r["g"]: r["auc"] for r in metrics.roc_auc(df, "y", "p", ["g"]).collect()}
    for g in (1, 2, None):
        pos, neg = [[p for k, y, p in rows if k == g and y == c] for c in (1, 0)]
        assert got[g] == pytest.approx(sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg))
    assert got[3] is None


def test_splits_partition_the_input(spark):
    df = spark.range(400).select(F.col("id").alias("clip_id"), (F.col("id") % 5 == 0).cast("int").alias("label_num"))
    sp = splits.stratified_split(df)
    parts = [sp.filter(F.col("split") == x).select("clip_id", "label_num") for x in ("train", "val", "test")]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert df.exceptAll(union).count() == 0 and union.exceptAll(df).count() == 0


def test_matrix_reassembly_and_1d_helpers(spark):
    from callscore.operators import matrices
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]]), (1, [[3.0, 2.0], [1.0, 0.0]])], "k int, m array<array<double>>")
    mean = matrices.assemble(matrices.elementwise_mean(df, ["k"], "m"), ["k"]).first()["m"]
    assert mean == [[2.0, 2.0], [2.0, 2.0]]
    y = spark.createDataFrame([([1.0, 2.0, 3.0],)], "y array<double>")
    r = y.select(A.pad_or_cut_1d("y", 5).alias("p"), A.pad_or_cut_1d("y", 2).alias("c"),
                 cleaning.cut_samples("y", sr=1).alias("s")).first()
    assert r["p"] == [1.0, 2.0, 3.0, 0.0, 0.0] and r["c"] == [1.0, 2.0] and r["s"] == [1.0, 2.0, 3.0]


def test_cells_from_counts_match_cell_counts(spark):
    df = spark.range(300).select((F.col("id") % 3 == 0).cast("int").alias("y"), ((F.col("id") * 7) % 10 / 10.0).alias("p"))
    a = metrics.cells_from_counts(metrics.score_counts(df, "y", "p"), "p").first()
    b = metrics.cell_counts(df, "y", metrics.predict("p")).first()
    assert [a[f"c_{i}_{j}"] for i in (0, 1) for j in (0, 1)] == [b[f"c_{i}_{j}"] for i in (0, 1) for j in (0, 1)]


def test_transcripts_do_not_depend_on_the_bucket_width(spark):
    # one call with 400 chunks, plus small calls
    rows = [(1, i, ("w%d " % i) * (i % 4)) for i in range(400)] + [(c, i, "x" * i) for c in range(2, 6) for i in range(5)]
    df = spark.createDataFrame(rows, "call_id long, chunk_index int, transcript string")
    for fn, lim in ((calls.final_text, 2048), (calls.running_text, 512)):
        plain = sorted(tuple(r) for r in fn(df, lim).collect())
        hot = sorted(tuple(r) for r in fn(df, lim, bucket_width=16).collect())
        assert hot == plain


def test_redelivered_chunk_counts_once_in_batch(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 1, "b"), (1, 2, "c")],
                               "call_id long, chunk_index int, transcript string")
    r = calls.final_text(df).first()
    assert r["n_segments"] == 3 and r["full_text"] == "a b c"


def test_sessioniser_mixed_routing(spark):
    import random
    rnd = random.Random(3)
    rows, lengths = [], {0: 400, 1: 30, 2: 45, 3: 12}
    for clip, n in lengths.items():
        v = 0
        for i in range(n):
            if rnd.random() < 0.2:
                v = 1 - v
            rows.append((clip, i, bool(v)))
    df = spark.createDataFrame(rows, "clip_id long, frame_no long, is_voiced boolean")
    for flush in (False, True):
        want = []
        for clip, n in lengths.items():
            fl = [int(r[2]) for r in rows if r[0] == clip]
            want += [(clip, i, *s) for i, s in enumerate(segments.sessionise(list(range(n)), fl, flush_open=flush))]
        got = sorted(tuple(r) for r in segments.voice_segments(df, bucket_frames=64, flush_open=flush).collect())
        assert got == sorted(want)


def test_class_weight_join_and_checked_broadcast(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "clip_id long, label_num int")
    w = {r["label_num"]: r["weight"] for r in splits.with_class_weight(df).select("label_num", "weight").distinct().collect()}
    # balanced: n / (k * n_c) -> 40 / (2 * 10) and 40 / (2 * 30)
    assert w[1] == pytest.approx(2.0) and w[0] == pytest.approx(40 / 60)
    small = spark.range(5)
    assert "ResolvedHint" in splits.checked_broadcast(small, 10)._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in splits.checked_broadcast(small, 10)._jdf.queryExecution().logical().toString().lower()
    big = spark.range(50)
    assert splits.checked_broadcast(big, 10) is big


def test_vectorised_run_equals_frame_by_frame():
    import random

    import numpy as np
    rng = random.Random(3)
    for _ in range(200):
        flags, v = [], 0
        for _ in range(rng.randrange(1, 300)):
            v = 1 - v if rng.random() < 0.15 else v
            flags.append(v)
        a, b, got, i = segments.VadMachine(), segments.VadMachine(), [], 0
        while i < len(flags):
            k = rng.randrange(1, 90)
            got += a.run(np.arange(i, min(i + k, len(flags))), np.array(flags[i:i + k]))
            i += k
        want = [r for r in map(b.step, range(len(flags)), flags) if r]
        assert got == want and a.state() == b.state()


def test_sessioniser_tree_of_buckets(spark):
    import random
    rng = random.Random(12)
    rows, v = [], 0
    for i in range(700):
        v = 1 - v if rng.random() < 0.12 else v
        rows.append((5, i, bool(v)))
    rows += [(6, i, True) for i in range(9)] + [(None, 1, True), (5, None, True)]
    df = spark.createDataFrame(rows, "clip_id long, frame_no long, is_voiced boolean")
    for flush in (False, True):
        want = []
        for clip in (5, 6):
            own = [int(r[2]) for r in rows if r[0] == clip and r[1] is not None]
            want += [(clip, k, *s) for k, s in enumerate(segments.sessionise(list(range(len(own))), own, flush_open=flush))]
        got = segments.voice_segments(df, bucket_frames=16, super_buckets=4, flush_open=flush)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_arrays_without_cells_and_samples_beyond_full_scale(spark):
    df = spark.createDataFrame([([], [1.2, -1.2, 0.5, float("nan")]), ([[]], []), (None, None), ([[1.0, 2.0], [3.0]], [0.0])],
                               "m array<array<double>>, y array<double>")
    rows = df.select(A.shape("m").alias("shape"), A.transpose("m").alias("t"), A.pad_or_cut_rows("m", 2).alias("p"), A.resize("m", 2, 2).alias("r"),
                     A.zero_fallback("m", 1, 1, 2).alias("z"), A.pcm16_roundtrip("y").alias("y")).collect()
    assert [r["shape"] for r in rows] == [[0, 0], [1, 0], [None, None], [2, 2]]
    assert [r["t"] for r in rows] == [[], [], None, [[1.0, 3.0], [2.0, None]]]
    assert rows[0]["p"] == [[], []] and rows[0]["r"] == [] and rows[1]["r"] == [] and rows[2]["r"] is None
    assert rows[0]["z"] == [[0.0, 0.0]]
    assert rows[0]["y"][0] == rows[0]["y"][0] == 32767 / A.PCM_SCALE and rows[0]["y"][1] == -32768 / A.PCM_SCALE and rows[0]["y"][3] == 0.0


def test_class_weights_keep_rows_without_a_label(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "clip_id long, label_num int")
    assert {r["clip_id"]: r["weight"] for r in splits.with_class_weight(df).collect()} == {
        1: pytest.approx(4 / 6), 2: pytest.approx(4 / 6), 3: pytest.approx(4 / 3), 4: pytest.approx(4 / 3)}


def test_map_groups_sees_each_group_once_and_whole(spark):
    from callscore.operators.grouped import map_groups
    rows = [(k, i) for k, n in ((1, 30), (2, 1), (3, 7), (None, 12), (4, 25)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        def count(pdf):
            import pandas as pd
            return pd.DataFrame([(pdf["k"].iloc[0], len(pdf), bool(pdf["i"].is_monotonic_increasing))], columns=["k", "n", "sorted"])
        got = map_groups(df, ["k"], ["i"], count, "k long, n long, sorted boolean").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r["k"] or 0, r["n"], r["sorted"]) for r in got) == [(0, 12, True), (1, 30, True), (2, 1, True), (3, 7, True), (4, 25, True)]


def test_a_redelivered_chunk_counts_whole(spark):
    """Text and both matrices of a chunk come from one delivery."""
    from callscore.operators import calls
    rows = [("a", 0, "b", [[1.0]], [[9.0]]), ("a", 0, "a", [[5.0]], [[2.0]]), ("a", 1, "x", [[7.0]], None), ("a", 1, "x", [[3.0]], [[4.0]]),
            ("a", 2, "m", [[8.0]], [[8.0]]), ("a", 2, "l", None, [[6.0]])]
    df = spark.createDataFrame(rows, "call_id string, chunk_index int, transcript string, mfcc array<array<double>>, spectrogram array<array<double>>")
    m, s = ({r["chunk_index"]: r[c] for r in calls._one_per_chunk(df, c).collect()} for c in ("mfcc", "spectrogram"))
    assert (m[0], s[0]) == ([5.0], [2.0]) and (m.get(2), s[2]) == (None, [6.0])
    assert (m[1], s.get(1)) in (([7.0], None), ([3.0], [4.0]))
    assert calls.final_text(df).first()["full_text"] == "a x l"
