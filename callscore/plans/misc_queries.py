"""Registered summary, preview, helper-function and scorer queries with twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scoring import stand_in_text_prob
from ..functions.text import call_id_from, clamp_label, weights_from_name
from ..operators import calls, fusion, models
from . import call_queries, eval_queries
from . import fixtures as fx
from .sqltext import text_prob
from .text_queries import _clean, _CLEAN, _LAB, LP


def q_final_summary_lines(spark, sf_dir):
    return calls.summary_text(calls.call_final(fx.chunk_matrices(spark, sf_dir)))


def q_offline_text_scores(spark, sf_dir):
    c = _clean(spark, sf_dir)
    return c.select("doc_id", F.round(stand_in_text_prob("transcription_clean", 3), 4).alias("bert_prob"))


def q_misc_functions(spark, sf_dir):
    ev = fx.call_events(spark, sf_dir)
    grid = fusion.candidate_name("w1", "w2", "w3")
    ws = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in fusion.WEIGHT_GRID])
    w = F.element_at(ws, (F.col("event_id") % len(fusion.WEIGHT_GRID)).cast("int") + 1)
    x = ev.select("event_id", call_id_from("call_id", "event").alias("hashed_id"),
                  w[0].alias("w1"), w[1].alias("w2"), w[2].alias("w3"),
                  clamp_label(F.col("value") / 100.0 - 0.2).alias("clamped"))
    parsed = weights_from_name(grid)
    return x.select("event_id", "hashed_id", "clamped", grid.alias("model"),
                    F.round(parsed[0] + parsed[1] + parsed[2], 6).alias("weight_sum"))


def q_preview_rows(spark, sf_dir):
    return _clean(spark, sf_dir).orderBy("doc_id").limit(5)


def q_best_fold(spark, sf_dir):
    s = eval_queries._scored(spark, sf_dir)
    from ..operators import splits
    long = fusion.candidates_long(splits.kfold(s))
    pf = fusion.per_fold_metrics(long)
    best = fusion.best_by(pf, ["cand"], "f1", "fold")
    return best.select("cand", "fold", *[F.round(c, 6).alias(c) for c in ("acc", "f1", "auc")])


def q_udf_matrix_scoring(spark, sf_dir):
    m = fx.matrices(spark, sf_dir).select("vec_id", F.flatten("m").alias("cells"))
    score = models.matrix_scorer_udf(models.stand_in_matrix_model(), 64)
    return m.select("vec_id", F.round(score("cells"), 6).alias("mfcc_prob"))


QUERIES = {
    "final_summary_lines": q_final_summary_lines,
    "offline_text_scores": q_offline_text_scores,
    "misc_functions": q_misc_functions,
    "preview_rows": q_preview_rows,
    "best_fold": q_best_fold,
    "udf_matrix_scoring": q_udf_matrix_scoring,
}

_F3 = "printf('%.3f', {})"
_SUMMARY = ("chr(10) || '" + calls.SUMMARY_RULE + "' || chr(10) || 'Call ID: ' || cast(call_id as varchar) || "
            "chr(10) || 'Total Segments: ' || cast(n_segments as varchar) || chr(10) || chr(10) || "
            "'Final Transcript:' || chr(10) || full_text || chr(10) || chr(10) || 'Final Decision: ' || status || "
            "chr(10) || 'Probability=' || " + _F3.format("final_prob") + " || '   (bert=' || " +
            _F3.format("bert_prob") + " || ', mfcc=' || " + _F3.format("mfcc_prob") + " || ', spec=' || " +
            _F3.format("spec_prob") + " || ')' || chr(10) || '" + calls.SUMMARY_END + "' || chr(10)")
_WG = "(values " + ", ".join(f"({i}, cast({a} as double), cast({b} as double), cast({c} as double))"
                              for i, (a, b, c) in enumerate(fusion.WEIGHT_GRID)) + ") g(k, w1, w2, w3)"

ORACLE = {
    "final_summary_lines": call_queries.ORACLE["call_final"].replace(
        "select call_id, n_segments, full_text, ", "select call_id, " + _SUMMARY + " as summary from (select "
        "call_id, n_segments, full_text, ", 1) + ") z",
    "offline_text_scores": fx.oracle(LP, f"select doc_id, round({text_prob('transcription_clean', 3)}, 4) as bert_prob "
                                         "from c", _LAB, _CLEAN),
    "misc_functions": fx.oracle(["call_events"], f"""select event_id,
  'call_' || substr(md5(call_id || ':' || event), 1, 8) as hashed_id,
  greatest(0, least(1, cast(trunc(value / 100.0 - 0.2) as int))) as clamped,
  'WeightedAvg(' || cast(w1 as varchar) || ', ' || cast(w2 as varchar) || ', ' || cast(w3 as varchar) || ')' as model,
  round(w1 + w2 + w3, 6) as weight_sum
  from call_events e join {_WG} on g.k = e.event_id % 10"""),
    "preview_rows": fx.oracle(LP, "select * from c order by doc_id limit 5", _LAB, _CLEAN),
    "best_fold": eval_queries.ORACLE["weight_grid_cv"].rsplit("select cv.cand", 1)[0] + """select cand, fold,
  round(acc, 6) as acc, round(f1, 6) as f1, round(auc, 6) as auc from (select *, row_number() over
  (partition by cand order by f1 desc, fold) as rn from pf) x where rn = 1""",
    "udf_matrix_scoring": fx.oracle(["matrices"], """select vec_id, round(1.0 / (1.0 + exp(-10.0 * m)), 6) as mfcc_prob
  from (select vec_id, list_avg(flatten(m)) as m from matrices) x"""),
}
