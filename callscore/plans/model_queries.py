"""Registered model queries (U1-U7, U9, S12). Only the batched scorer has a
DuckDB twin (its stand-in model equals the SQL stand-in); trained models are
checked by rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text, label_num
from ..operators import calls, fusion, metrics, models, scorer, splits
from ..session import scratch_path
from . import call_queries
from . import fixtures as fx
from . import sqltext
from .eval_queries import _scored

# Training settings of the registered CV queries: the library's own, whole
# (tests set fewer iterations).
CHECK_GBT = models.GBT_SETTINGS
CHECK_MLP_ITER = models.MLP_MAX_ITER


def q_udf_scoring(spark, sf_dir):
    fin = calls.final_text(fx.chunks(spark, sf_dir))
    score = models.scorer_udf(models.stand_in_text_model())
    return fin.select("call_id", F.round(score("full_text"), 4).alias("bert_prob"))


def q_scorer_failures(spark, sf_dir):
    """A model that raises on every batch with a planted text; only these rows are Unscored."""
    score = scorer.resilient_scorer(scorer.stand_in_model(lambda text: len(text) % 7 == 0))
    return calls.call_final(fx.chunk_matrices(spark, sf_dir), score).drop("full_text")


def q_text_model_eval(spark, sf_dir):
    lt = fx.labelled_text(spark, sf_dir).select("doc_id", "label",
                                                clean_text("transcription").alias("text"))
    lt = lt.withColumn("label_num", label_num("label"))
    sp = splits.stratified_split(lt, id_col="doc_id")
    train = models.weighted(sp.filter(F.col("split") == "train"))
    model = models.text_classifier().fit(train)
    pred = models.positive_prob(model.transform(sp.filter(F.col("split") == "test")))
    cc = metrics.cell_counts(pred, "label_num", metrics.predict("p"))
    s = metrics.summary_from_cells(cc).select("n", "accuracy", "f1_weighted")
    s = s.withColumn("_g", F.lit(0))
    auc = metrics.roc_auc(pred.withColumn("_g", F.lit(0)), "label_num", "p", ["_g"])
    return s.join(auc, "_g").drop("_g")  # one row each


def q_matrix_model_eval(spark, sf_dir):
    m = models.matrix_features(fx.matrices(spark, sf_dir), "m")
    sp = splits.stratified_split(m, label="label", id_col="vec_id")
    train = models.weighted(sp.filter(F.col("split") == "train"), label="label")
    model = models.matrix_classifier().fit(train)
    pred = model.transform(sp.filter(F.col("split") != "train"))
    return pred.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                     F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def _ranking(spark, sf_dir):
    """Folded scores, trained candidates, and one ranking of all candidates:
    trained ones, the simple average and the best weighted average."""
    scores = _scored(spark, sf_dir)
    d = splits.kfold(scores)
    cands = models.candidates(fusion.PROBS, gbt_settings=CHECK_GBT, mlp_max_iter=CHECK_MLP_ITER)
    trained = models.cv_summary(models.cv_predictions(d, cands))
    untrained = fusion.untrained_cv_summary(scores).drop("rank")
    return d, cands, models.ranked(trained.unionByName(untrained))


def q_meta_model_cv(spark, sf_dir):
    return _ranking(spark, sf_dir)[2]


def q_best_meta_model(spark, sf_dir):
    """U9 + S12: the best of trained and untrained candidates, refit and saved."""
    d, cands, ranking = _ranking(spark, sf_dir)
    name = ranking.orderBy("rank").first()["model"]      # one row of a candidate table
    weights = None
    if name.startswith("WeightedAvg"):
        weights = [float(x) for x in name[len("WeightedAvg("):-1].split(",")]
    elif name == "SimpleAvg":
        weights = [1 / 3] * 3
    return models.refit_and_save(spark, d, name, cands, scratch_path(spark, "best_fusion"), weights)


def q_logreg_folds(spark, sf_dir):
    """The logistic fusion model fold by fold: rows and positives held out,
    the gradient where it stopped (0 at the optimum), and whether accuracy and
    AUC recomputed from the held-out predictions agree with the metrics."""
    d = splits.kfold(_scored(spark, sf_dir)).persist()
    pipeline = models.candidates(fusion.PROBS)["LogReg"]
    parts = []
    for f in range(splits.N_FOLDS):
        train, held = d.filter(F.col("fold") != f), d.filter(F.col("fold") == f)
        model = pipeline.fit(train)
        pred = models.positive_prob(model.transform(held)).select(F.lit(f).alias("fold"), "label_num", "p")
        counts = pred.groupBy("fold").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("label_num").cast("long")).alias("n_pos"),
            F.avg(((F.col("p") > 0.5).cast("int") == F.col("label_num")).cast("double")).alias("acc_plain"))
        own = fusion.per_fold_metrics(pred, "label_num", ("fold",))
        gradient = models.logistic_gradient(model, train, fusion.PROBS).select(F.lit(f).alias("fold"), F.round("gradient", 3).alias("gradient"))
        parts.append(counts.join(own, "fold").join(gradient, "fold"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    agree = (F.abs(F.col("acc") - F.col("acc_plain")) < 1e-9) & F.col("auc").between(0.0, 1.0)
    return out.select("fold", "n", "n_pos", (F.col("gradient") + 0.0).alias("gradient"), agree.alias("agree"))


QUERIES = {
    "udf_scoring": q_udf_scoring,
    "scorer_failures": q_scorer_failures,
    "text_model_eval": q_text_model_eval,
    "matrix_model_eval": q_matrix_model_eval,
    "meta_model_cv": q_meta_model_cv,
    "best_meta_model": q_best_meta_model,
    "logreg_folds": q_logreg_folds,
}

ORACLE = {
    "scorer_failures": call_queries.ORACLE["call_unscored"],
    "logreg_folds": fx.oracle(["scored"], """select cast(fold as int) as fold, count(*) as n, cast(sum(label_num) as bigint) as n_pos,
  cast(0 as double) as gradient, true as agree from fo group by fold""", ("s", "select clip_id, label_num from scored"), ("fo", sqltext.folds("s"))),
    "udf_scoring": call_queries.ORACLE["call_final"].replace(
        "select call_id, n_segments, full_text, ", "select call_id, bert_prob from (select call_id, ", 1) + ") z",
}
