"""Registered split / metric / fusion queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scoring import api_label, fuse, fuse_mean
from ..operators import fusion, metrics, splits
from . import fixtures as fx
from . import sqltext as sq
from .text_queries import _clean, _CLEAN, _LAB, LP

R = 6  # decimals kept for floating outputs


def _r(df, cols):
    return df.select(*[F.round(c, R).alias(c) if c in cols else F.col(c) for c in df.columns])


def _scored(spark, sf_dir):
    s = fx.scored(spark, sf_dir)
    return s.select("clip_id", "label_num", F.col("p1").alias("bert_prob"), F.col("p2").alias("mfcc_prob"),
                    F.col("p3").alias("spec_prob"))


def _default_fused(df):
    return df.withColumn("final_prob", fuse([F.col(c) for c in fusion.PROBS]))


def _score_long(spark, sf_dir):
    s = _default_fused(_scored(spark, sf_dir))
    names = [*fusion.PROBS, "final_prob"]
    return s.select("label_num", F.inline(F.array(*[F.struct(F.lit(n).alias("score"), F.col(n).alias("p"))
                                                     for n in names])))


def q_stratified_split(spark, sf_dir):
    return splits.stratified_split(_scored(spark, sf_dir)).select("clip_id", "label_num", "split")


def q_kfold(spark, sf_dir):
    return splits.kfold(_scored(spark, sf_dir)).select("clip_id", "label_num", "fold")


def q_split_stats(spark, sf_dir):
    c = splits.stratified_split(_clean(spark, sf_dir), id_col="doc_id")
    return _r(metrics.split_stats(c), ["dur_min", "dur_mean", "dur_median", "dur_max", "text_share"])


def q_class_weights(spark, sf_dir):
    return _r(splits.class_weights(_scored(spark, sf_dir)), ["weight"])


def q_confusion(spark, sf_dir):
    s = _default_fused(_scored(spark, sf_dir))
    return metrics.confusion(s, "label_num", metrics.predict("final_prob"))


def _summary(spark, sf_dir):
    s = _default_fused(_scored(spark, sf_dir))
    return metrics.summary_from_cells(metrics.cell_counts(s, "label_num", metrics.predict("final_prob")))


def q_binary_prf(spark, sf_dir):
    return _r(_summary(spark, sf_dir).select("precision", "recall", "f1", "accuracy"),
              ["precision", "recall", "f1", "accuracy"])


def q_weighted_f1(spark, sf_dir):
    return _r(_summary(spark, sf_dir).select("n", "f1_weighted", "f1_macro"), ["f1_weighted", "f1_macro"])


def q_class_report(spark, sf_dir):
    s = _default_fused(_scored(spark, sf_dir))
    return _r(metrics.class_report(s, "label_num", metrics.predict("final_prob")),
              ["precision", "recall", "f1", "support"])


def q_roc_auc(spark, sf_dir):
    return _r(metrics.roc_auc(_score_long(spark, sf_dir), "label_num", "p", ["score"]), ["auc"])


def q_log_loss(spark, sf_dir):
    return _r(metrics.log_loss(_score_long(spark, sf_dir), "label_num", "p", ["score"]),
              ["weighted_nll", "smoothed_nll"])


def q_score_join(spark, sf_dir):
    """Three modality score tables aligned by clip id; clips of error events
    have no spectrogram score (failed audio), so that side is a left join."""
    s = fx.scored(spark, sf_dir)
    ev = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("clip_id"), "event_type")
    bert = s.select("clip_id", F.col("p1").alias("bert_prob"))
    mfcc = s.select("clip_id", F.col("p2").alias("mfcc_prob"))
    spec = s.join(ev.filter(F.col("event_type") != "error"), "clip_id", "left_semi") \
        .select("clip_id", F.col("p3").alias("spec_prob"))
    return fusion.score_table(bert, mfcc, spec, s.select("clip_id", "label_num"), how="left")


def q_ensemble_mean(spark, sf_dir):
    s = fx.scored(spark, sf_dir)
    long = s.select("clip_id", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("p"))
                                                  for m, c in (("m1", "p1"), ("m2", "p2"), ("m3", "p3"))])))
    return _r(fusion.ensemble_mean(long), ["spec_prob"])


def q_fuse_weighted(spark, sf_dir):
    s = _default_fused(_scored(spark, sf_dir))
    return _r(s.select("clip_id", "final_prob", api_label("final_prob").alias("label")), ["final_prob"])


def q_fuse_mean(spark, sf_dir):
    s = _scored(spark, sf_dir)
    m = fuse_mean([F.col(c) for c in fusion.PROBS])
    out = s.select("clip_id", m.alias("mean_prob")).withColumn("pred", metrics.predict("mean_prob"))
    return _r(out, ["mean_prob"])


_CV = [f"{m}_{s}" for m in fusion.METRICS for s in ("mean", "std")]


def q_weight_grid_cv(spark, sf_dir):
    return _r(fusion.weight_grid_cv(_scored(spark, sf_dir)), _CV)


def q_best_weights(spark, sf_dir):
    return _r(fusion.best_candidate(fusion.weight_grid_cv(_scored(spark, sf_dir))), _CV)


def q_fusion_cv_summary(spark, sf_dir):
    return _r(fusion.untrained_cv_summary(_scored(spark, sf_dir)), _CV)


QUERIES = {
    "stratified_split": q_stratified_split,
    "kfold": q_kfold,
    "split_stats": q_split_stats,
    "class_weights": q_class_weights,
    "confusion": q_confusion,
    "binary_prf": q_binary_prf,
    "weighted_f1": q_weighted_f1,
    "class_report": q_class_report,
    "roc_auc": q_roc_auc,
    "log_loss": q_log_loss,
    "score_join": q_score_join,
    "ensemble_mean": q_ensemble_mean,
    "fuse_weighted": q_fuse_weighted,
    "fuse_mean": q_fuse_mean,
    "weight_grid_cv": q_weight_grid_cv,
    "best_weights": q_best_weights,
    "fusion_cv_summary": q_fusion_cv_summary,
}

# ------------------------------------------------------------------ twins
_S = ("s", "select clip_id, label_num, p1 as bert_prob, p2 as mfcc_prob, p3 as spec_prob from scored")
_FUSED = "(cast(0.6 as double) * bert_prob + cast(0.2 as double) * mfcc_prob + cast(0.2 as double) * spec_prob)"
_SF = ("sf", f"select *, {_FUSED} as final_prob, case when {_FUSED} > 0.5 then 1 else 0 end as pred from s")
_LONG = ("lg", "select label_num, 'bert_prob' as score, bert_prob as p from sf union all "
               "select label_num, 'mfcc_prob', mfcc_prob from sf union all "
               "select label_num, 'spec_prob', spec_prob from sf union all "
               "select label_num, 'final_prob', final_prob from sf")
_CELLS = ("cc", sq.cells("sf", "label_num", "pred", []))
_SUMM = ("sm", sq.summary("cc", []))
_GRID = ("grid", "select * from (values " + ", ".join(
    f"({i}, cast({a} as double), cast({b} as double), cast({c} as double))"
    for i, (a, b, c) in enumerate(fusion.WEIGHT_GRID)) + ") t(cand, w1, w2, w3)")
_FO = ("fo", sq.folds("s"))
_CANDS = ("cl", """select fo.label_num, fo.fold, g.cand, g.w1 * bert_prob + g.w2 * mfcc_prob + g.w3 * spec_prob as p
  from fo cross join grid g""")
_CANDS_M = ("cl", """select fo.label_num, fo.fold, g.cand, g.w1 * bert_prob + g.w2 * mfcc_prob + g.w3 * spec_prob as p
  from fo cross join grid g union all
  select label_num, fold, -1, (bert_prob + mfcc_prob + spec_prob) / 3.0 from fo""")
_PF = [("pc", sq.cells("(select *, case when p > 0.5 then 1 else 0 end as pred from cl) z", "label_num", "pred",
                       ["cand", "fold"])),
       ("ps", sq.summary("pc", ["cand", "fold"])),
       *sq.auc_ctes("cl", "label_num", "p", ["cand", "fold"]),
       ("pf", "select ps.cand, ps.fold, ps.accuracy as acc, ps.f1_weighted as f1, a_u.auc from ps "
              "join a_u on ps.cand = a_u.cand and ps.fold = a_u.fold"),
       ("cv", "select cand, " + ", ".join(f"round(avg({m}), 6) as {m}_mean, round(stddev_pop({m}), 6) as {m}_std"
                                          for m in fusion.METRICS) + " from pf group by cand")]
_CVCOLS = ", ".join(f"cv.{c}" for c in _CV)


ORACLE = {
    "stratified_split": fx.oracle(["scored"], "select clip_id, label_num, split from sp",
                                  _S, ("sp", sq.split("s"))),
    "kfold": fx.oracle(["scored"], "select clip_id, label_num, fold from fo", _S, _FO),
    "split_stats": fx.oracle(LP, """select split, count(*) as n, cast(sum(label_num) as bigint) as n_pos,
  cast(sum(1 - label_num) as bigint) as n_neg, round(min(duration_sec), 6) as dur_min,
  round(avg(duration_sec), 6) as dur_mean, round(quantile_cont(duration_sec, 0.5), 6) as dur_median,
  round(max(duration_sec), 6) as dur_max,
  round(avg(case when length(coalesce(transcription_clean, '')) >= 3 then 1.0 else 0.0 end), 6) as text_share
  from sp group by split""", _LAB, _CLEAN, ("sp", sq.split("c", id_col="doc_id"))),
    "class_weights": fx.oracle(["scored"], """select label_num, n, round(sum(n) over () / (count(*) over () * n), 6)
  as weight from (select label_num, count(*) as n from scored group by label_num) x"""),
    "confusion": fx.oracle(["scored"], """select a.actual, b.predicted, count(sf.label_num) as n
  from (values (0), (1)) a(actual) cross join (values (0), (1)) b(predicted)
  left join sf on sf.label_num = a.actual and sf.pred = b.predicted group by a.actual, b.predicted""", _S, _SF),
    "binary_prf": fx.oracle(["scored"], "select " + ", ".join(f"round({c}, 6) as {c}" for c in
                                                              ("precision", "recall", "f1", "accuracy")) + " from sm",
                            _S, _SF, _CELLS, _SUMM),
    "weighted_f1": fx.oracle(["scored"], "select n, round(f1_weighted, 6) as f1_weighted, round(f1_macro, 6) as f1_macro"
                                         " from sm", _S, _SF, _CELLS, _SUMM),
    "class_report": fx.oracle(["scored"], """select row, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, round(support, 6) as support from (
  select 'Non_Fraudulent' as row, p0 as precision, r0 as recall, f0 as f1, cast(s0 as double) as support from pcl
  union all select 'Fraudulent', p1, r1, f1_, cast(s1 as double) from pcl
  union all select 'accuracy', acc, acc, acc, acc from pcl
  union all select 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1_) / 2.0, cast(s0 + s1 as double) from pcl
  union all select 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
    (f0 * s0 + f1_ * s1) / (s0 + s1), cast(s0 + s1 as double) from pcl) x""", _S, _SF, _CELLS,
                              ("pcl", f"""select {sq.sdiv('c_0_0', 'c_0_0 + c_1_0')} as p0, {sq.sdiv('c_0_0', 'c_0_0 + c_0_1')} as r0,
  {sq.sdiv('2 * c_0_0', '(c_0_0 + c_0_1) + (c_0_0 + c_1_0)')} as f0, c_0_0 + c_0_1 as s0,
  {sq.sdiv('c_1_1', 'c_0_1 + c_1_1')} as p1, {sq.sdiv('c_1_1', 'c_1_0 + c_1_1')} as r1,
  {sq.sdiv('2 * c_1_1', '(c_1_0 + c_1_1) + (c_0_1 + c_1_1)')} as f1_, c_1_0 + c_1_1 as s1,
  {sq.sdiv('c_0_0 + c_1_1', 'c_0_0 + c_0_1 + c_1_0 + c_1_1')} as acc from cc""")),
    "roc_auc": fx.oracle(["scored"], "select score, round(auc, 6) as auc from a_u", _S, _SF, _LONG,
                         *sq.auc_ctes("lg", "label_num", "p", ["score"])),
    "log_loss": fx.oracle(["scored"], """select score, round(avg(s / n), 6) as weighted_nll,
  round(sum(sm) / sum(n), 6) as smoothed_nll from (
  select score, label_num, sum(nll) as s, count(*) as n, sum(0.9 * nll + 0.1 * uni) as sm from (
    select score, label_num, -(case when label_num = 1 then ln(q) else ln(1 - q) end) as nll,
      -(ln(q) + ln(1 - q)) / 2 as uni from (select *, least(greatest(p, 1e-15), 1 - 1e-15) as q from lg) a) b
  group by score, label_num) c group by score""", _S, _SF, _LONG),
    "score_join": fx.oracle(["scored"], """select s.clip_id, s.label_num, s.p1 as bert_prob, s.p2 as mfcc_prob,
  t.p3 as spec_prob from scored s left join (select s2.clip_id, s2.p3 from scored s2 join events e
  on s2.clip_id = e.event_id where e.event_type <> 'error') t on s.clip_id = t.clip_id"""),
    "ensemble_mean": fx.oracle(["scored"], """select clip_id, round(avg(p), 6) as spec_prob, count(*) as n_models from (
  select clip_id, p1 as p from scored union all select clip_id, p2 from scored union all select clip_id, p3 from scored) x
  group by clip_id"""),
    "fuse_weighted": fx.oracle(["scored"], """select clip_id, round(final_prob, 6) as final_prob,
  case when final_prob >= 0.5 then 'Fraudulent' else 'Non-Fraudulent' end as label from sf""", _S, _SF),
    "fuse_mean": fx.oracle(["scored"], """select clip_id, round(m, 6) as mean_prob, case when m > 0.5 then 1 else 0 end
  as pred from (select clip_id, (bert_prob + mfcc_prob + spec_prob) / 3.0 as m from s) x""", _S),
    "weight_grid_cv": fx.oracle(["scored"], f"select cv.cand, g.w1, g.w2, g.w3, {_CVCOLS} from cv join grid g "
                                            "on cv.cand = g.cand", _S, _GRID, _FO, _CANDS, *_PF),
    "best_weights": fx.oracle(["scored"], f"select cv.cand, g.w1, g.w2, g.w3, {_CVCOLS} from cv join grid g "
                                          "on cv.cand = g.cand order by f1_mean desc, cv.cand limit 1",
                              _S, _GRID, _FO, _CANDS, *_PF),
    "fusion_cv_summary": fx.oracle(["scored"], f"""select model, {', '.join(_CV)},
  row_number() over (order by f1_mean desc, cand) as rank from (
  select 'SimpleAvg' as model, -1 as cand, {_CVCOLS} from cv where cand = -1
  union all select * from (select 'WeightedAvg(' || cast(g.w1 as varchar) || ', ' || cast(g.w2 as varchar) || ', '
    || cast(g.w3 as varchar) || ')', cv.cand, {_CVCOLS} from cv join grid g on cv.cand = g.cand
    order by f1_mean desc, cv.cand limit 1) b) x""", _S, _GRID, _FO, _CANDS_M, *_PF),
}
