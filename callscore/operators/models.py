"""Model surface on Spark ML.

* U1/U2: the scorer is whatever the user supplies; it runs on executors as
  an Arrow-batched ``predict_batch_udf`` (one model load per Python worker,
  fixed batch size), never per row and never on the driver.
* U3/U4: text and matrix classifiers with balanced class weights
  (``weightCol`` from a k-row class table).
* U5-U7: fusion meta-models compared by stratified k-fold CV. Each fit is a
  distributed Spark ML job; all fold predictions are evaluated together by
  one grouped metric query (accuracy, weighted F1, AUC). Boosted trees see
  features by bins only, so they are fitted on the counts of the rows that
  share all bins and the label (``CountedGBT``).
* U9/S12: refit the winner on all rows and persist it with its metadata.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import HashingTF, IDF, QuantileDiscretizer, RegexTokenizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import metrics, trees
from .fusion import per_fold_metrics
from .splits import with_class_weight

# ---- fixed values (candidate settings) ----
SEED = 42
LOGREG_MAX_ITER = 500
MLP_HIDDEN = (16, 8)
MLP_MAX_ITER = 1000
GBT_SETTINGS = {                       # name -> (iterations, step size, depth, subsample)
    "GBT_a": (400, 0.05, 3, 0.9),
    "GBT_b": (1000, 0.03, 3, 0.9),
}
TREE_BINS = 32                         # bins of a feature in boosted trees
MARGIN_TREES = 10                      # trees between two stored margins
TASK_DRAWS = 1 << 26                   # draws (cells x iterations) that one task holds, of 1, 2 or 4 bytes
TEXT_FEATURES = 1 << 18
BATCH_SIZE = 512


# ------------------------------------------------------------------ U1 / U2
def scorer_udf(make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]], batch_size: int = BATCH_SIZE,
               input_type=T.StringType()):
    """Wrap a user model loader as a batched scorer returning one probability.

    ``make_predict`` runs once per Python worker (model load); the returned
    function gets a numpy batch and returns a float array."""
    return predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size,
                             input_tensor_shapes=None)


def stand_in_text_model(min_chars: int = 2):
    """Loader of the deterministic stand-in text model (same rule as the SQL
    stand-in scorer): (len % 101) / 100, 0.5 for short or missing text."""
    def make():
        def predict(texts: np.ndarray) -> np.ndarray:
            s = pd.Series(texts, dtype=object)
            t = s.fillna("").astype(str)
            short = s.isna().to_numpy() | (t.str.strip().str.len().to_numpy() < min_chars)
            return np.where(short, 0.5, (t.str.len().to_numpy() % 101) / 100.0)
        return predict
    return make


def stand_in_matrix_model():
    """Loader of the stand-in matrix model: logistic of 10 x the mean cell."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            m = np.asarray(x, dtype=np.float64).reshape(len(x), -1).mean(axis=1)
            return 1.0 / (1.0 + np.exp(-10.0 * m))
        return predict
    return make


def matrix_scorer_udf(make_predict, n_cells: int, batch_size: int = BATCH_SIZE):
    """Batched scorer over flattened matrices of a fixed cell count."""
    return predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size,
                             input_tensor_shapes=[[n_cells]])


# ------------------------------------------------------------------ U3 / U4
def text_classifier(text_col: str = "text", label: str = "label_num", weight: str = "weight") -> Pipeline:
    """Tokenise, hash, IDF, class-weighted logistic regression."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"\W+", minTokenLength=1),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=TEXT_FEATURES),
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight, maxIter=100, regParam=0.01),
    ])


def matrix_features(df: DataFrame, m: str, out: str = "features") -> DataFrame:
    """U4: flatten a matrix column into an ML vector."""
    return df.withColumn(out, array_to_vector(F.flatten(F.col(m))))


def matrix_classifier(label: str = "label", weight: str = "weight") -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight, maxIter=100,
                              regParam=0.01, family="multinomial")


def positive_prob(pred: DataFrame, out: str = "p") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


# ------------------------------------------------------------------ U5 - U7
def _drawn(rate: float, iters: int, seed: int):
    """Of ``n`` rows, how many each iteration draws when it takes every row with
    probability ``rate``. The draws of a cell depend on the seed and its key only."""
    @F.pandas_udf("array<long>")
    def draw(n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([trees.draws(c, k, rate, iters, seed) for c, k in zip(n, key)])
    return draw


def cells(data: DataFrame, bins: Sequence[str], label: str) -> DataFrame:
    """The rows counted by all bins and the label: (bins, label, n)."""
    return data.groupBy(*bins, label).agg(F.count(F.lit(1)).alias("n"))


def _categories(data: DataFrame, col: str) -> int:
    """How many categories Spark's trees take a column to have; -1: it is numeric."""
    attr = data.schema[col].metadata.get("ml_attr", {})
    known = {"nominal": len(attr.get("vals", [])) or attr.get("num_vals", -1), "binary": 2}
    return known.get(attr.get("type"), -1)


class CountedGBT(Estimator):
    """Gradient-boosted trees for a 0/1 label on binned features, log loss.

    A tree sees a row by its bins alone, and rows of the same bins and label
    have the same margin, so every iteration works on counted cells: at most
    2 * TREE_BINS ** features of them and never more than rows, however many
    rows there are. An iteration takes each row with probability ``subsample``:
    of a cell's n rows it takes a binomial draw, as row by row.

    Counting the rows is a job over all of them. More than ``MARGIN_TREES`` trees
    on at most ``TASK_DRAWS`` draws are then grown in one task (``trees.boosted``),
    so that a tree is not a few jobs of its own; otherwise, and where a column has
    more than ``TREE_BINS`` values, it is. Both give the same trees."""

    def __init__(self, bins: Sequence[str], label: str, iters: int, step: float, depth: int, subsample: float, seed: int = SEED):
        super().__init__()
        self.bins, self.label, self.iters, self.step, self.depth, self.subsample, self.seed = list(bins), label, iters, step, depth, subsample, seed

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        from ..session import scratch_root

        spark = dataset.sparkSession
        scratch_root(spark)
        counted = cells(dataset, self.bins, self.label).withColumn("_key", F.xxhash64(*self.bins, self.label)).checkpoint()
        n, *bins = counted.agg(F.count(F.lit(1)), *[F.count_distinct(c) for c in self.bins]).first()
        if self.iters > MARGIN_TREES and n * self.iters <= TASK_DRAWS and max(bins) <= TREE_BINS:
            return self._saved_model(spark, self._grown(counted))
        counted = counted.withColumn("_drawn", _drawn(self.subsample, self.iters, self.seed)("n", "_key"))
        sign = F.when(F.col(self.label) == 1, 1.0).when(F.col(self.label) == 0, -1.0)
        data = VectorAssembler(inputCols=self.bins, outputCol="features").transform(counted).select(
            "features", "_drawn", sign.alias("_y"), F.lit(0.0).alias("_margin")).checkpoint()
        tree, grown = self._tree(), []
        for i in range(self.iters):
            # the first tree is fitted to the labels, the next ones to the negative gradient
            residual = F.col("_y") if i == 0 else 4 * F.col("_y") / (1 + F.exp(2 * F.col("_y") * F.col("_margin")))
            drawn = data.select("features", residual.alias("_residual"), F.col("_drawn")[i].cast("double").alias("_weight"))
            drawn = drawn.where("_weight > 0").persist()        # a fit reads its rows several times
            grown.append(tree.fit(drawn))
            drawn.unpersist()
            data = grown[-1].transform(data).withColumn("_margin", F.col("_margin") + self._weight(i) * F.col("_tree")).drop("_tree")
            if i % MARGIN_TREES == MARGIN_TREES - 1 and i + 1 < self.iters:
                data = data.checkpoint()
        return self._model(spark, grown)

    def _tree(self) -> DecisionTreeRegressor:
        return DecisionTreeRegressor(labelCol="_residual", weightCol="_weight", predictionCol="_tree", maxDepth=self.depth, maxBins=TREE_BINS, seed=self.seed)

    def _grown(self, counted: DataFrame) -> DataFrame:
        """All trees grown in one task, as rows of Spark ML's saved form."""
        bins, label, args = self.bins, self.label, (self.iters, self.step, self.depth, self.subsample, self.seed)
        arity = [_categories(counted, c) for c in bins]

        def grow(batches):
            c = pd.concat(list(batches))
            if c[[*bins, label]].isna().any(axis=None) or not c[label].isin([0, 1]).all():
                raise ValueError("bins must not be null, labels must be 0 or 1")
            rows = list(trees.boosted(c[bins].to_numpy(np.float64).T, c[label].to_numpy(), c["n"].to_numpy(), c["_key"].to_numpy(), arity, *args))
            yield pd.DataFrame({"treeID": [i for i, _ in rows], "nodeData": [n for _, n in rows]})

        return counted.repartition(1).mapInPandas(grow, trees.NODES)

    def _saved_model(self, spark: SparkSession, nodes: DataFrame) -> GBTClassificationModel:
        """The model read from its saved form: that of one tree, with all nodes in place."""
        from ..session import scratch_path

        one, whole = scratch_path(spark, "gbt_form"), scratch_path(spark, "gbt")
        row = VectorAssembler(inputCols=self.bins, outputCol="features").transform(
            spark.createDataFrame([(*[0.0] * len(self.bins), 0.0, 1.0)], [*self.bins, "_residual", "_weight"]))
        self._model(spark, [self._tree().fit(row)]).write().save(one)
        nodes.write.parquet(f"{whole}/data")
        form = json.loads(spark.read.text(f"{one}/metadata").first()[0]) | {"numTrees": self.iters}
        spark.createDataFrame([(json.dumps(form),)], "value string").coalesce(1).write.text(f"{whole}/metadata")
        of_one = spark.read.parquet(f"{one}/treesMetadata")
        tree, text, weight = of_one.columns
        of_all = of_one.select(F.explode(F.sequence(F.lit(0), F.lit(self.iters - 1))).alias(tree), text)
        of_all.withColumn(weight, F.when(F.col(tree) == 0, self._weight(0)).otherwise(self._weight(1))).write.parquet(f"{whole}/treesMetadata")
        return GBTClassificationModel.load(whole)

    def _weight(self, i: int) -> float:
        return 1.0 if i == 0 else self.step

    def _model(self, spark: SparkSession, grown: list) -> GBTClassificationModel:
        """The trees as Spark ML's own model, which predicts, saves and loads."""
        sc = spark.sparkContext
        jvm = sc._jvm
        parts = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(grown))
        weights = sc._gateway.new_array(jvm.double, len(grown))
        for i, t in enumerate(grown):
            parts[i], weights[i] = t._java_obj, self._weight(i)
        return GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, parts, weights))


def candidates(feature_cols: Sequence[str], label: str = "label_num",
               gbt_settings: dict | None = None, mlp_max_iter: int = MLP_MAX_ITER) -> dict[str, Pipeline]:
    """The trained fusion candidates."""
    asm = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    out = {
        "LogReg": Pipeline(stages=[asm, LogisticRegression(labelCol=label, maxIter=LOGREG_MAX_ITER)]),
        "MLP": Pipeline(stages=[asm, StandardScaler(inputCol="features", outputCol="_scaled", withMean=True),
                                MultilayerPerceptronClassifier(featuresCol="_scaled", labelCol=label,
                                                               layers=[len(feature_cols), *MLP_HIDDEN, 2],
                                                               maxIter=mlp_max_iter, seed=SEED)]),
    }
    for name, (iters, step, depth, sub) in (gbt_settings or GBT_SETTINGS).items():
        bins = [f"_bin_{c}" for c in feature_cols]
        out[name] = Pipeline(stages=[QuantileDiscretizer(numBuckets=TREE_BINS, inputCols=list(feature_cols), outputCols=bins),
                                     VectorAssembler(inputCols=bins, outputCol="features"),
                                     CountedGBT(bins, label, iters, step, depth, sub)])
    return out


def cv_predictions(folded: DataFrame, cands: dict[str, Pipeline], label: str = "label_num",
                   k: int = 5, parallelism: int = 4) -> DataFrame:
    """Out-of-fold class-1 probabilities for every candidate: (model, fold, label, p).

    Fits are independent Spark ML jobs; up to ``parallelism`` run at once
    (as ``CrossValidator(parallelism=...)`` does). The folded input, which every
    fit reads, and the predictions, which every metric reads, are kept in the
    shared checkpoint folder."""
    from concurrent.futures import ThreadPoolExecutor

    from ..session import scratch_root

    scratch_root(folded.sparkSession)
    folded = folded.checkpoint()
    # candidates in turn: short jobs of trees run beside an MLP's passes over all rows
    jobs = [(name, f) for f in range(k) for name in cands]

    def fit(job):
        name, f = job
        return cands[name].fit(folded.filter(F.col("fold") != f))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        fitted = list(ex.map(fit, jobs))
    parts = []
    for (name, f), model in zip(jobs, fitted):
        pred = positive_prob(model.transform(folded.filter(F.col("fold") == f)))
        parts.append(pred.select(F.lit(name).alias("model"), F.lit(f).alias("fold"), label, "p"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.checkpoint()


def cv_summary(preds: DataFrame, label: str = "label_num") -> DataFrame:
    """Per model mean/std over folds of accuracy, weighted F1 and AUC."""
    return metrics.fold_summary(per_fold_metrics(preds, label, ("model", "fold")), ["model"], ("acc", "f1", "auc"))


def ranked(summary: DataFrame, by: str = "f1_mean") -> DataFrame:
    """O1: one ranking of candidates (a row each), ties by name."""
    from pyspark.sql import Window
    return summary.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), F.asc("model"))).cast("long"))


def logistic_gradient(model, data: DataFrame, feature_cols: Sequence[str], label: str = "label_num") -> DataFrame:
    """One row with the largest absolute component of the mean gradient of the
    log loss at a fitted logistic regression; 0 at the optimum."""
    error = F.col("p") - F.col(label)
    means = [F.abs(F.avg(error * F.col(c))) for c in feature_cols] + [F.abs(F.avg(error))]
    return positive_prob(model.transform(data)).agg(F.greatest(*means).alias("gradient"))


# ------------------------------------------------------------------ U9 / S12
def refit_and_save(spark: SparkSession, data: DataFrame, best_name: str, cands: dict[str, Pipeline],
                   path: str, weights: Sequence[float] | None = None) -> DataFrame:
    """Persist what won: a fitted pipeline, or the weights of an untrained
    average; metadata is a one-row JSON table next to it."""
    if best_name in cands:
        model: PipelineModel = cands[best_name].fit(data)
        model.write().overwrite().save(f"{path}/model")
        meta = {"best_model": best_name, "type": "spark_ml", "path": f"{path}/model"}
    else:
        meta = {"best_model": best_name, "type": "weighted_average", "weights": list(weights or [])}
    m = spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string")
    m.coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return spark.read.text(f"{path}/meta").select(F.col("value").alias("meta"))


def weighted(df: DataFrame, label: str = "label_num") -> DataFrame:
    return with_class_weight(df, label)
