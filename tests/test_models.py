"""Trained models on the smallest tables: their rows hold real values."""

import json

import pytest
from pyspark.sql import functions as F

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler

from callscore.operators import fusion, models, splits
from callscore.plans import model_queries
from callscore.plans.eval_queries import _scored


def test_cross_validation_and_ranking(spark, small_dir, monkeypatch):
    # few iterations: the values are checked, not how good they are
    monkeypatch.setattr(model_queries, "CHECK_GBT", {"GBT_a": (3, 0.05, 3, 0.9)})
    monkeypatch.setattr(model_queries, "CHECK_MLP_ITER", 5)
    d, cands, ranking = model_queries._ranking(spark, small_dir)
    rows = ranking.collect()
    names = {r["model"] for r in rows}
    assert {"LogReg", "MLP", "GBT_a", "SimpleAvg"} <= names and len(rows) == 5
    ordered = sorted(rows, key=lambda r: r["rank"])
    assert [r["rank"] for r in ordered] == [1, 2, 3, 4, 5]
    assert all(a["f1_mean"] >= b["f1_mean"] for a, b in zip(ordered, ordered[1:]))
    for r in rows:
        assert all(0 <= r[f"{m}_mean"] <= 1 and r[f"{m}_std"] >= 0 for m in ("acc", "f1", "auc"))


def test_metrics_recomputed_from_predictions(spark, small_dir):
    d = splits.kfold(_scored(spark, small_dir))
    preds = models.cv_predictions(d, {"LogReg": models.candidates(fusion.PROBS)["LogReg"]})
    rows = [(r["fold"], r["label_num"], r["p"]) for r in preds.collect()]
    assert len(rows) == d.count()
    for r in fusion.per_fold_metrics(preds, "label_num", ("model", "fold")).collect():
        own = [(y, p) for f, y, p in rows if f == r["fold"]]
        pos, neg = [[p for y, p in own if y == c] for c in (1, 0)]
        auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
        assert r["auc"] == pytest.approx(auc)
        assert r["acc"] == pytest.approx(sum((p > 0.5) == bool(y) for y, p in own) / len(own))


def test_best_model_is_saved(spark, small_dir, monkeypatch):
    monkeypatch.setattr(model_queries, "CHECK_GBT", {"GBT_a": (2, 0.05, 3, 0.9)})
    monkeypatch.setattr(model_queries, "CHECK_MLP_ITER", 3)
    meta = json.loads(model_queries.q_best_meta_model(spark, small_dir).first()["meta"])
    assert meta["type"] in ("spark_ml", "weighted_average")
    if meta["type"] == "spark_ml":
        from pyspark.ml import PipelineModel
        scored = PipelineModel.load(meta["path"]).transform(_scored(spark, small_dir))
        assert scored.where(F.col("prediction").isNull()).count() == 0
    else:
        assert sum(meta["weights"]) == pytest.approx(1, abs=0.02)


def test_text_and_matrix_models(spark, small_dir):
    t = model_queries.q_text_model_eval(spark, small_dir).first()
    assert t["n"] > 0 and all(0 <= t[c] <= 1 for c in ("accuracy", "f1_weighted", "auc"))
    parts = {r["split"]: r for r in model_queries.q_matrix_model_eval(spark, small_dir).collect()}
    assert set(parts) == {"val", "test"} and all(r["n"] > 0 and 0 <= r["accuracy"] <= 1 for r in parts.values())


def _few_values(spark, n):
    """Rows of a few values a feature: these are their own bins."""
    return spark.range(n).select(*[(F.floor(F.rand(k) * 6)).cast("double").alias(c) for k, c in enumerate("abc")], F.rand(9).alias("r")).select(
        "a", "b", "c", F.when(F.col("r") * 12 < F.col("a") + F.abs(F.col("b") - 2), 1).otherwise(0).alias("label_num"))


def test_counted_trees_equal_trees_of_rows(spark):
    """All rows drawn: the same probabilities as Spark's trees over the rows themselves."""
    rows = _few_values(spark, 3000).persist()
    counted = models.CountedGBT(["a", "b", "c"], "label_num", 12, 0.3, 3, 1.0)
    features = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    plain = GBTClassifier(labelCol="label_num", maxIter=12, stepSize=0.3, maxDepth=3, seed=42).fit(features)
    got, want = ([r["p"] for r in models.positive_prob(m.transform(features)).orderBy("a", "b", "c", "label_num").select("p").collect()]
                 for m in (counted.fit(features), plain))
    assert got == pytest.approx(want, abs=1e-9) and len(set(got)) > 20
    rows.unpersist()


def test_counted_trees_draw_rows(spark):
    """A cell's draws are those of its rows: binomial, each iteration its own."""
    drawn = spark.range(300).select(F.lit(1000).alias("n"), "id").select(models._drawn(0.9, 40, 1)("n", "id").alias("d")).collect()
    flat = [x for r in drawn for x in r["d"]]
    mean = sum(flat) / len(flat)
    assert mean == pytest.approx(900, abs=1) and sum((x - mean) ** 2 for x in flat) / len(flat) == pytest.approx(90, rel=0.1)
    assert len({tuple(r["d"]) for r in drawn}) == 300


def test_trees_see_cells_not_rows(spark, monkeypatch):
    """What the trees are fitted on does not grow with the rows."""
    seen, fit = [], models.DecisionTreeRegressor.fit
    monkeypatch.setattr(models.DecisionTreeRegressor, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    data = _few_values(spark, 20000)
    models.candidates(["a", "b", "c"], gbt_settings={"GBT": (2, 0.1, 3, 0.9)})["GBT"].fit(data)
    assert len(seen) == 2 and max(seen) <= 2 * 6 ** 3


def _iterations(cands):
    """Iterations a candidate trains for, by name."""
    last = {name: p.getStages()[-1] for name, p in cands.items()}
    return {name: s.iters if isinstance(s, models.CountedGBT) else s.getMaxIter() for name, s in last.items()}


def _without_fits(monkeypatch):
    """Every candidate predicts one of the features; what was to be fitted is kept."""
    seen = []

    def predicted(folded, cands, label="label_num", **_):
        seen.append(cands)
        return folded.select(F.explode(F.array(*[F.lit(c) for c in cands])).alias("model"), "fold", label, F.col("bert_prob").alias("p"))

    monkeypatch.setattr(models, "cv_predictions", predicted)
    return seen


def test_best_model_trains_whole(spark, small_dir, monkeypatch):
    """The candidates compared and the one refit train for the reference's iterations."""
    seen = _without_fits(monkeypatch)
    monkeypatch.setattr(models, "refit_and_save", lambda spark, data, name, cands, path, weights=None: seen.append(cands))
    model_queries.q_best_meta_model(spark, small_dir)
    assert [_iterations(c) for c in seen] == [{"LogReg": 500, "MLP": 1000, "GBT_a": 400, "GBT_b": 1000}] * 2


@pytest.mark.parametrize("binned", [False, True])
def test_trees_of_one_task_equal_trees_of_jobs(spark, monkeypatch, binned, tmp_path):
    """The same draws and trees whether grown in one task or by a job a level: nodes, thresholds or categories, and predictions."""
    data = _few_values(spark, 4000).select(*[(F.col(c) / 7 if binned else F.col(c)).alias(c) for c in "abc"], "label_num").persist()
    fit = models.candidates(["a", "b", "c"], gbt_settings={"GBT": (14, 0.3, 3, 0.7)})["GBT"] if binned else \
        models.Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), models.CountedGBT(["a", "b", "c"], "label_num", 14, 0.3, 3, 0.7)])
    found = []
    for most in (1 << 26, 0):
        monkeypatch.setattr(models, "TASK_DRAWS", most)
        gbt = fit.fit(data)
        gbt.write().save(f"{tmp_path}/{most}")
        again = models.PipelineModel.load(f"{tmp_path}/{most}")
        found.append((gbt.stages[-1], [r["p"] for r in models.positive_prob(again.transform(data)).orderBy("a", "b", "c", "label_num").select("p").collect()]))
    (one, p), (jobs, q) = found
    assert p == pytest.approx(q, abs=1e-9) and len(set(p)) > 20
    assert one.getNumTrees == jobs.getNumTrees == 14 and one.treeWeights == jobs.treeWeights
    assert [t.numNodes for t in one.trees] == [t.numNodes for t in jobs.trees] and one.numFeatures == jobs.numFeatures
    assert one.featureImportances.toArray().tolist() == pytest.approx(jobs.featureImportances.toArray().tolist(), abs=1e-9)
    data.unpersist()


def test_many_trees_are_few_jobs(spark, monkeypatch):
    """Hundreds of trees on a bounded number of cells: Spark's own trees are fitted for the form of a saved model only."""
    seen, fit = [], models.DecisionTreeRegressor.fit
    monkeypatch.setattr(models.DecisionTreeRegressor, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    model = models.candidates(["a", "b", "c"], gbt_settings={"GBT": (300, 0.03, 3, 0.9)})["GBT"].fit(_few_values(spark, 3000))
    assert model.stages[-1].getNumTrees == 300 and seen == [1]


def test_cross_validation_trains_whole(spark, small_dir, monkeypatch):
    """Every candidate of the cross-validation trains for the reference's iterations."""
    seen = _without_fits(monkeypatch)
    names = {r["model"] for r in model_queries.q_meta_model_cv(spark, small_dir).collect()}
    assert [_iterations(c) for c in seen] == [{"LogReg": 500, "MLP": 1000, "GBT_a": 400, "GBT_b": 1000}] and set(seen[0]) < names
