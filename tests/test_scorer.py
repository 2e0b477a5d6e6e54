"""The batched scorer: bad rows alone fail, whatever batch they are in."""

import json
import time

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscore.functions.scoring import score_columns
from callscore.operators import scorer


def _run(predict, n, limit=None):
    return scorer.score_rows(predict, list(range(n)), [None] * n, [None] * n, limit)


def test_bad_rows_are_isolated_in_few_calls():
    bad, calls = {3, 200, 201, 511}, []

    def predict(texts, mfcc, spec):
        calls.append(len(texts))
        if bad & set(texts):
            raise KeyError("bad")
        return np.full((len(texts), 3), 0.25)

    p, errors = _run(predict, 512)
    assert {i for i, e in enumerate(errors) if e} == bad and errors[3] == "KeyError: 'bad'"
    assert np.isnan(p[sorted(bad)]).all() and (np.delete(p, sorted(bad), 0) == 0.25).all() and len(calls) < 4 * 2 * 10
    assert _run(predict, 0)[1] == []


def test_wrong_answers_are_errors():
    assert _run(lambda t, m, s: np.zeros((1, 3)), 3)[1] == [None] * 3    # halved until one row gets one answer
    p, errors = _run(lambda t, m, s: np.array([[0.5, x, 0.5] for x in (0.1, 1.5, float("nan"), 1.0)]), 4)
    assert errors == [None, "ValueError: not a probability", "ValueError: not a probability", None] and np.isnan(p[1]).all()
    assert all("scores for" in e for e in _run(lambda t, m, s: np.zeros(2), 2)[1])


def test_time_limit():
    def predict(texts, mfcc, spec):
        while 2 in texts:
            time.sleep(0.01)
        return np.zeros((len(texts), 3))

    began = time.time()
    _, errors = _run(predict, 4, limit=0.2)
    assert [bool(e) for e in errors] == [False, False, True, False] and "no answer in 0.2 s" in errors[2] and time.time() - began < 5


def test_scorer_in_a_plan_and_in_the_stream(spark):
    score = scorer.resilient_scorer(scorer.stand_in_model(lambda t: t is not None and "bad" in t), batch_rows=4)
    rows = [(i, None if i == 7 else "bad one" if i % 5 == 0 else f"text {i}", [0.1 * i] if i % 2 else None) for i in range(23)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("i", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("m", T.ArrayType(T.DoubleType()))]))
    scored = score_columns(df, "t", "m", scorer=score, error="error")
    plain = score_columns(df, "t", "m")
    want = {r["i"]: r for r in plain.collect()}
    for r in scored.collect():
        failed = r["i"] % 5 == 0
        assert (r["status"] == "Unscored") == failed and (r["error"] == "RuntimeError: planted") == failed
        assert failed or [r[c] for c in plain.columns] == [want[r["i"]][c] for c in plain.columns]
    from pyspark.sql import Observation
    seen = Observation("scores")
    scorer.observe_errors(scored, name=seen).count()
    assert seen.get == {"rows": 23, "errors": 5}
    assert score_columns(df.where("false"), "t", scorer=score).count() == 0

    from callscore.sources import envelope as env
    from callscore.streaming import calls as scalls
    from callscore.streaming.runner import run_waves
    chunk = lambda i, t: json.dumps({"call_id": "a", "chunk_index": i, "event": "CHUNK", "transcript": t})
    msgs = spark.createDataFrame([(0, chunk(0, "fine")), (1, chunk(1, "bad"))], "wave int, value string")
    schema = scalls.OUTPUT_SCHEMA + ", bert_prob double, mfcc_prob double, spec_prob double, final_prob double, status string"
    out = run_waves(spark, msgs, lambda s: scalls.with_decisions(scalls.call_states(env.decode(s)), score), schema, "t_scorer")
    assert sorted((r["chunk_index"], r["status"] == "Unscored") for r in out.where(F.col("kind") == "running").collect()) == [(0, False), (1, True)]
