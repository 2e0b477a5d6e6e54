"""Classification metrics as aggregate queries.

Every metric is one grouped aggregate with map-side partial aggregation;
``group`` columns let the same code evaluate many candidates and folds in a
single pass. ROC AUC orders the *distinct* scores (after a partial
aggregate); a group with more distinct scores than fit one task is split
into approximate-quantile ranges for a two-level prefix sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import score_bucket

# ---- fixed values ----
CLASSES = (0, 1)
CLASS_NAMES = ("Non_Fraudulent", "Fraudulent")
THRESHOLD = 0.5
LOG_EPS = 1e-15
SMOOTHING = 0.1


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def predict(p: str, threshold: float = THRESHOLD, inclusive: bool = False) -> Column:
    c = F.col(p) >= threshold if inclusive else F.col(p) > threshold
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def cell_counts(df: DataFrame, y: str, pred: Column, group: Sequence[str] = (),
                classes: Sequence[int] = CLASSES) -> DataFrame:
    """One row per group with ``c_<a>_<b>`` = #(y = a and pred = b)."""
    aggs = [F.count(F.when((F.col(y) == a) & (pred == b), 1)).alias(f"c_{a}_{b}") for a in classes for b in classes]
    return df.groupBy(*group).agg(*aggs)


def confusion(df: DataFrame, y: str, pred: Column, group: Sequence[str] = (),
              classes: Sequence[int] = CLASSES) -> DataFrame:
    """Long form (group, actual, predicted, n), zero cells included."""
    cc = cell_counts(df, y, pred, group, classes)
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c_{a}_{b}").alias("n"))
                      for a in classes for b in classes])
    return cc.select(*group, F.inline(cells))


def per_class(cc: DataFrame, group: Sequence[str] = (), classes: Sequence[int] = CLASSES) -> DataFrame:
    """Per class precision/recall/F1/support from cell counts (one row per group and class)."""
    rows = []
    for c in classes:
        tp = F.col(f"c_{c}_{c}")
        sup = sum((F.col(f"c_{c}_{b}") for b in classes), F.lit(0))
        prd = sum((F.col(f"c_{a}_{c}") for a in classes), F.lit(0))
        prec, rec = _safe_div(tp, prd), _safe_div(tp, sup)
        f1 = _safe_div(2 * tp, sup + prd)
        rows.append(F.struct(F.lit(c).alias("cls"), prec.alias("precision"), rec.alias("recall"),
                             f1.alias("f1"), sup.cast("long").alias("support")))
    return cc.select(*group, F.inline(F.array(*rows)))


def summary_from_cells(cc: DataFrame, group: Sequence[str] = (), classes: Sequence[int] = CLASSES,
                       keep: Sequence[str] = ()) -> DataFrame:
    """accuracy, weighted F1, macro F1 and the binary P/R/F1 of class 1 per group
    (``keep`` columns are passed through)."""
    n = sum((F.col(f"c_{a}_{b}") for a in classes for b in classes), F.lit(0))
    correct = sum((F.col(f"c_{c}_{c}") for c in classes), F.lit(0))
    f1s, wsum = [], F.lit(0.0)
    for c in classes:
        tp = F.col(f"c_{c}_{c}")
        sup = sum((F.col(f"c_{c}_{b}") for b in classes), F.lit(0))
        prd = sum((F.col(f"c_{a}_{c}") for a in classes), F.lit(0))
        f1 = _safe_div(2 * tp, sup + prd)
        f1s.append((c, f1, tp, sup, prd))
        wsum = wsum + sup * f1
    pos = [x for x in f1s if x[0] == classes[-1]][0]
    return cc.select(
        *group, *keep,
        n.cast("long").alias("n"),
        _safe_div(correct, n).alias("accuracy"),
        _safe_div(wsum, n).alias("f1_weighted"),
        (sum((x[1] for x in f1s), F.lit(0.0)) / F.lit(float(len(classes)))).alias("f1_macro"),
        _safe_div(pos[2], pos[4]).alias("precision"),
        _safe_div(pos[2], pos[3]).alias("recall"),
        pos[1].alias("f1"),
    )


def class_report(df: DataFrame, y: str, pred: Column, group: Sequence[str] = (),
                 classes: Sequence[int] = CLASSES, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """Per class rows, then accuracy, macro avg, weighted avg.

    As in a report dict turned into a table, the accuracy row repeats the
    accuracy in every column (support included)."""
    cc = cell_counts(df, y, pred, group, classes)
    k = F.lit(float(len(classes)))
    total = lambda xs: sum(xs[1:], xs[0])
    n = total([F.col(f"c_{a}_{b}") for a in classes for b in classes])
    row = lambda name, *v: F.struct(F.lit(name).alias("row"), *[x.cast("double").alias(c) for x, c in zip(v, ("precision", "recall", "f1", "support"))])
    rows, per = [], []
    for c, name in zip(classes, names):
        tp = F.col(f"c_{c}_{c}")
        sup, prd = total([F.col(f"c_{c}_{b}") for b in classes]), total([F.col(f"c_{a}_{c}") for a in classes])
        per.append((_safe_div(tp, prd), _safe_div(tp, sup), _safe_div(2 * tp, sup + prd), sup))
        rows.append(row(name, *per[-1]))
    accuracy = _safe_div(total([F.col(f"c_{c}_{c}") for c in classes]), n)
    rows.append(row("accuracy", *[accuracy] * 4))
    rows.append(row("macro avg", *[total([x[i] for x in per]) / k for i in range(3)], n))
    rows.append(row("weighted avg", *[_safe_div(total([x[i] * x[3] for x in per]), n) for i in range(3)], n))
    # every row of the report comes from the one row of cell counts
    return cc.select(*group, F.inline(F.array(*rows)))


def score_counts(df: DataFrame, y: str, p: str, group: Sequence[str] = ()) -> DataFrame:
    """(group, p, _pos, _neg): label counts per distinct score (a partial aggregate)."""
    return df.groupBy(*group, p).agg(F.sum(F.col(y).cast("long")).alias("_pos"),
                                     F.sum((1 - F.col(y)).cast("long")).alias("_neg"))


def cells_from_counts(d: DataFrame, p: str, group: Sequence[str] = (), threshold: float = THRESHOLD) -> DataFrame:
    """Binary cell counts ``c_<actual>_<pred>`` from a score-count table."""
    hi = F.col(p) > threshold
    return d.groupBy(*group).agg(
        F.sum(F.when(hi, 0).otherwise(F.col("_neg"))).alias("c_0_0"), F.sum(F.when(hi, F.col("_neg")).otherwise(0)).alias("c_0_1"),
        F.sum(F.when(hi, 0).otherwise(F.col("_pos"))).alias("c_1_0"), F.sum(F.when(hi, F.col("_pos")).otherwise(0)).alias("c_1_1"))


def auc_from_counts(d: DataFrame, p: str, group: Sequence[str] = (), with_cells: bool = False,
                    threshold: float = THRESHOLD) -> DataFrame:
    """AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).

    One pass: inside a (group, score bucket) a window sums the negatives below
    each score; the buckets' totals, at most a few thousand rows a group, are
    then summed in score order, and a bucket adds its positives times all
    negatives of earlier buckets. ``with_cells`` adds the binary cell counts at
    ``threshold`` to the same aggregates."""
    group = list(group)
    d = d.withColumn("_bk", score_bucket(p))
    below = Window.partitionBy(*group, "_bk").orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.col("_pos").cast("double") * (F.coalesce(F.sum("_neg").over(below), F.lit(0)) + F.col("_neg") * F.lit(0.5))
    hi = F.col(p) > threshold
    cells = {"c_0_0": F.when(hi, 0).otherwise(F.col("_neg")), "c_0_1": F.when(hi, F.col("_neg")).otherwise(0),
             "c_1_0": F.when(hi, 0).otherwise(F.col("_pos")), "c_1_1": F.when(hi, F.col("_pos")).otherwise(0)} if with_cells else {}
    local = d.withColumn("_u", inside).groupBy(*group, "_bk").agg(
        F.sum("_u").alias("_u"), F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"), *[F.sum(c).alias(k) for k, c in cells.items()])
    earlier = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    local = local.withColumn("_u", F.col("_u") + F.col("_P").cast("double") * F.coalesce(F.sum("_N").over(earlier), F.lit(0)))
    agg = local.groupBy(*group).agg(F.sum("_u").alias("_u"), F.sum("_P").alias("_P"), F.sum("_N").alias("_N"), *[F.sum(k).alias(k) for k in cells])
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                 F.col("_u") / (F.col("_P").cast("double") * F.col("_N").cast("double")))
    return agg.select(*group, auc.alias("auc"), *cells)


def roc_auc(df: DataFrame, y: str, p: str, group: Sequence[str] = ()) -> DataFrame:
    """ROC AUC with average-rank ties, one row per group; null when a class is missing."""
    return auc_from_counts(score_counts(df, y, p, group), p, group)


def log_loss(df: DataFrame, y: str, p: str, group: Sequence[str] = (), eps: float = LOG_EPS,
             smoothing: float = SMOOTHING) -> DataFrame:
    """Balanced class-weighted cross entropy and the label-smoothed mean,
    from stored class-1 probabilities."""
    q = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    nll = -F.when(F.col(y) == 1, F.log(q)).otherwise(F.log(1 - q))
    uniform = -(F.log(q) + F.log(1 - q)) / 2
    sm = (1 - smoothing) * nll + smoothing * uniform
    per = df.groupBy(*group, y).agg(F.sum(nll).alias("_s"), F.count(F.lit(1)).alias("_n"), F.sum(sm).alias("_sm"))
    # balanced weights n/(k n_c): the weighted mean reduces to the mean of class means
    return per.groupBy(*group).agg(F.avg(F.col("_s") / F.col("_n")).alias("weighted_nll"),
                                   (F.sum("_sm") / F.sum("_n")).alias("smoothed_nll"))


def split_stats(df: DataFrame, split: str = "split", y: str = "label_num", dur: str = "duration_sec",
                text: str = "transcription_clean", min_chars: int = 3) -> DataFrame:
    """A4: n, classes, duration min/mean/median/max, share of text with >= 3 chars.

    The exact median keeps a value -> count map per split; durations are cut
    to 30 s at 3 decimals, so the map is bounded (<= 30,001 entries)."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("n_pos"),
        F.sum((1 - F.col(y)).cast("long")).alias("n_neg"),
        F.min(dur).alias("dur_min"), F.avg(dur).alias("dur_mean"),
        F.percentile(dur, 0.5).alias("dur_median"), F.max(dur).alias("dur_max"),
        F.avg(F.when(F.length(F.coalesce(F.col(text), F.lit(""))) >= min_chars, 1.0).otherwise(0.0))
        .alias("text_share"))


def fold_summary(per_fold: DataFrame, group: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and population std over folds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.groupBy(*group).agg(*aggs)
