"""Stratified train/val/test split, stratified k-fold assignment, class
weights (W11, W12, A5, A6, J5).

Rows are ordered inside each class by ``md5(id:seed)`` (deterministic and
replay-safe). With two classes, ``row_number().over(partitionBy(label))``
would run each class in a single task, so the rank is computed in two levels
with buckets taken from the leading hash digits, which are uniform (see
``prefix.running_totals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import hash_bucket, running_totals

# ---- fixed values ----
SEED = 42
N_FOLDS = 5
HASH_DIGITS = 3          # 4,096 buckets per class


def hash_key(id_col: str, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def class_ranks(df: DataFrame, label: str, id_col: str, seed: int = SEED, digits: int = HASH_DIGITS) -> DataFrame:
    """Add ``_r`` (0-based rank in the class, hash order) and ``_n`` (class size)."""
    d = df.withColumn("_h", hash_key(id_col, seed))
    return running_totals(d, [label], ["_h", id_col], hash_bucket("_h", digits), rank="_r", count="_n").drop("_h")


def stratified_split(df: DataFrame, label: str = "label_num", id_col: str = "clip_id", seed: int = SEED) -> DataFrame:
    """Per class, ceil(n/4) rows leave train; of those ceil(2/5) go to test, the rest to val
    (75 / 15 / 10 overall). Integer arithmetic, so both engines cut at the same rows."""
    r = class_ranks(df, label, id_col, seed)
    n_tmp = F.floor((F.col("_n") + 3) / 4)
    n_test = F.floor((n_tmp * 2 + 4) / 5)
    split = F.when(F.col("_r") < n_test, "test").when(F.col("_r") < n_tmp, "val").otherwise("train")
    return r.withColumn("split", split).drop("_r", "_n")


def kfold(df: DataFrame, label: str = "label_num", id_col: str = "clip_id", k: int = N_FOLDS,
          seed: int = SEED, digits: int = HASH_DIGITS) -> DataFrame:
    """fold = (rows in earlier classes + rank in class) mod k, classes in
    label order, a null label before all others."""
    d = df.withColumn("_h", hash_key(id_col, seed))
    d = running_totals(d, [label], ["_h", id_col], hash_bucket("_h", digits), rank="_g", across=True)
    return d.withColumn("fold", (F.col("_g") % k).cast("int")).drop("_h", "_g")


def class_counts(df: DataFrame, label: str = "label_num") -> DataFrame:
    """A5."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str = "label_num") -> DataFrame:
    """Balanced weight n / (k * n_c), one row per class (k rows)."""
    c = class_counts(df, label)
    w = Window.partitionBy()  # the class table has k rows
    return c.select(label, "n", (F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n"))).alias("weight"))


def checked_broadcast(small: DataFrame, max_rows: int = 10000) -> DataFrame:
    """Broadcast ``small`` only after counting it (a cheap job on an aggregated
    table); above ``max_rows`` it stays a shuffle join."""
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def with_class_weight(df: DataFrame, label: str = "label_num", weight_col: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every row; rows without a label
    are a class of their own and stay."""
    cw = class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias(weight_col))
    return df.join(checked_broadcast(cw), F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")
