"""Score fusion and untrained fusion-candidate evaluation (P14, P15, J1,
A16, U8, U7 for untrained candidates, O1, O2, X1).

The weight grid never goes through a join: every row emits its candidate
scores with ``inline`` (a generator inside the same stage), and all
candidates x folds are evaluated by one grouped aggregate plus one AUC
pass. Fold assignment is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import fuse, fuse_mean
from . import metrics
from .splits import kfold

# ---- fixed values: the candidate weight grid, in its original order ----
WEIGHT_GRID = (
    (0.50, 0.25, 0.25),
    (0.60, 0.20, 0.20),
    (0.50, 0.40, 0.10),
    (0.40, 0.30, 0.30),
    (0.33, 0.33, 0.34),
    (0.30, 0.40, 0.30),
    (0.30, 0.30, 0.40),
    (0.25, 0.25, 0.50),
    (0.25, 0.50, 0.25),
    (0.20, 0.40, 0.40),
)
PROBS = ("bert_prob", "mfcc_prob", "spec_prob")
METRICS = ("acc", "f1", "auc")


def score_table(bert: DataFrame, mfcc: DataFrame, spec: DataFrame, labels: DataFrame, key: str = "clip_id",
                how: str = "inner") -> DataFrame:
    """Align three modality score tables and the labels by key (not by position)."""
    return labels.join(bert, key, how).join(mfcc, key, how).join(spec, key, how)


def ensemble_mean(long_scores: DataFrame, key: str = "clip_id", p: str = "p", out: str = "spec_prob") -> DataFrame:
    """Mean class-1 probability over k models, from a (key, model, p) table."""
    return long_scores.groupBy(key).agg(F.avg(p).alias(out), F.count(F.lit(1)).alias("n_models"))


def candidates_long(df: DataFrame, probs: Sequence[str] = PROBS, grid=WEIGHT_GRID,
                    keep: Sequence[str] = ("label_num", "fold"), with_mean: bool = False) -> DataFrame:
    """One row per (input row, candidate) with the candidate's fused score ``p``."""
    items = [F.struct(F.lit(i).alias("cand"), fuse([F.col(c) for c in probs], w).alias("p"))
             for i, w in enumerate(grid)]
    if with_mean:
        items.append(F.struct(F.lit(-1).alias("cand"), fuse_mean([F.col(c) for c in probs]).alias("p")))
    return df.select(*keep, F.inline(F.array(*items)))


def per_fold_metrics(long: DataFrame, y: str = "label_num", group: Sequence[str] = ("cand", "fold")) -> DataFrame:
    """acc, weighted F1 and AUC per candidate and fold, all from one score-count
    table (the exploded candidate rows are aggregated once)."""
    group = list(group)
    d = metrics.score_counts(long, y, "p", group)
    a = metrics.auc_from_counts(d, "p", group, with_cells=True)
    s = metrics.summary_from_cells(a, group, keep=["auc"])
    return s.select(*group, F.col("accuracy").alias("acc"), F.col("f1_weighted").alias("f1"), "auc")


def weight_grid_cv(df: DataFrame, probs: Sequence[str] = PROBS, grid=WEIGHT_GRID, y: str = "label_num",
                   id_col: str = "clip_id", folds: DataFrame | None = None) -> DataFrame:
    """U8: every weight triple, 5 stratified folds, mean/std of acc, F1, AUC."""
    src = df.select(id_col, y, *probs)
    f = folds if folds is not None else kfold(src, y, id_col)
    long = candidates_long(f, probs, grid, keep=(y, "fold"))
    pf = per_fold_metrics(long, y)
    summ = metrics.fold_summary(pf, ["cand"], METRICS)
    weights = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in grid])
    w = F.element_at(weights, F.col("cand") + 1)
    return summ.select("cand", w[0].alias("w1"), w[1].alias("w2"), w[2].alias("w3"),
                       *[f"{m}_{s}" for m in METRICS for s in ("mean", "std")])


def best_candidate(cv: DataFrame, metric: str = "f1_mean", order_col: str = "cand") -> DataFrame:
    """O2: highest mean F1; ties keep the earlier candidate."""
    best = cv.agg(F.max_by(F.struct(*cv.columns), F.struct(F.col(metric), -F.col(order_col))).alias("b"))
    return best.select("b.*")


def candidate_name(w1, w2, w3):
    """``WeightedAvg(w1, w2, w3)`` as the candidate is named in reports."""
    return F.concat(F.lit("WeightedAvg("), F.col(w1).cast("string"), F.lit(", "), F.col(w2).cast("string"),
                    F.lit(", "), F.col(w3).cast("string"), F.lit(")"))


def untrained_cv_summary(df: DataFrame, probs: Sequence[str] = PROBS, grid=WEIGHT_GRID, y: str = "label_num",
                         id_col: str = "clip_id") -> DataFrame:
    """U7 (untrained candidates) + X1 + O1: SimpleAvg and the best weighted
    average stacked and ranked by mean F1 (ties keep candidate order)."""
    src = df.select(id_col, y, *probs)
    f = kfold(src, y, id_col)
    long = candidates_long(f, probs, grid, keep=(y, "fold"), with_mean=True)
    pf = per_fold_metrics(long, y)
    summ = metrics.fold_summary(pf, ["cand"], METRICS)
    weights = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in grid])
    w = F.element_at(weights, F.col("cand") + 1)
    grid_rows = summ.filter(F.col("cand") >= 0).select("*", w[0].alias("w1"), w[1].alias("w2"), w[2].alias("w3"))
    best = best_candidate(grid_rows).select(candidate_name("w1", "w2", "w3").alias("model"), "cand",
                                            *[f"{m}_{s}" for m in METRICS for s in ("mean", "std")])
    simple = summ.filter(F.col("cand") == -1).select(F.lit("SimpleAvg").alias("model"), F.lit(-1).alias("cand"),
                                                      *[f"{m}_{s}" for m in METRICS for s in ("mean", "std")])
    both = simple.unionByName(best)
    order = F.row_number().over(Window.orderBy(F.desc("f1_mean"), F.asc("cand")))  # two rows
    return both.withColumn("rank", order.cast("long")).drop("cand")


def best_by(df: DataFrame, group: Sequence[str], metric: str, order_col: str) -> DataFrame:
    """Per group, the row with the highest ``metric``; ties keep the earliest ``order_col``."""
    cols = [c for c in df.columns if c not in group]
    b = df.groupBy(*group).agg(F.max_by(F.struct(*cols), F.struct(F.col(metric), -F.col(order_col))).alias("_b"))
    return b.select(*group, "_b.*")
