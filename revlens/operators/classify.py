"""Sentiment classifiers on ``pyspark.ml``.

Features are either smoothed TF-IDF (CountVectorizer -> IDF -> ElementwiseProduct(idf + 1)
-> L2 Normalizer, i.e. ``tf * (ln((1+N)/(1+df)) + 1)``) or pooled embeddings. Class balance
uses a ``weightCol`` of balanced weights n / (k n_c). Tuning is cross-validation over a
seeded random sample of the grid with stratified folds from :mod:`revlens.operators.split`.
"""

from __future__ import annotations

import random
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.functions import predict_batch_udf
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators import evaluate as EV
from revlens.operators.split import assign_folds, with_class_weights


# A fit/transform extension point with Params ------------------------------------------------
class SmoothTfidf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed TF-IDF over token arrays, L2-normalised (B4 as an Estimator)."""

    vocabSize = Param(Params._dummy(), "vocabSize", "max vocabulary size (the default keeps every term)", typeConverter=TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "minimum document frequency", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol="tokens", outputCol="features", vocabSize=(1 << 31) - 1, minDF=1.0):
        super().__init__()
        self._setDefault(vocabSize=(1 << 31) - 1, minDF=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        tf_col, idf_col = self.uid + "_tf", self.uid + "_idf"
        cv = CountVectorizer(inputCol=self.getInputCol(), outputCol=tf_col, vocabSize=self.getOrDefault("vocabSize"), minDF=self.getOrDefault("minDF"))
        cvm = cv.fit(df)
        idfm = IDF(inputCol=tf_col, outputCol=idf_col).fit(cvm.transform(df))
        scale = DenseVector(idfm.idf.toArray() + 1.0)  # Spark's ln((N+1)/(df+1)) plus one
        ew = ElementwiseProduct(scalingVec=scale, inputCol=tf_col, outputCol=idf_col)
        norm = Normalizer(p=2.0, inputCol=idf_col, outputCol=self.getOutputCol())
        return PipelineModel(stages=[cvm, ew, norm])


def balanced(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    """Balanced weights, counted over the training rows where ``df`` has a ``split``."""
    train = df.where(F.col("split") == "train") if "split" in df.columns else df
    return with_class_weights(df, label, weight_col, train)


def fit_input(df: DataFrame, rows_per_partition: int = 1_000_000) -> DataFrame:
    """Cache the input of an iterative estimator; the caller releases it.

    Every optimizer iteration is a job over all partitions, so they are coalesced to one per
    ``rows_per_partition`` rows, but never below the number of cores.
    """
    df = df.cache()
    n = df.count()
    target = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // rows_per_partition))
    if df.rdd.getNumPartitions() > target:
        out = df.coalesce(target).cache()
        out.count()
        df.unpersist()
        return out
    return df


# M1 ----------------------------------------------------------------------------------------------
def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(modelType="multinomial", smoothing=smoothing, featuresCol="features", labelCol="label")


# M2 ----------------------------------------------------------------------------------------------
def linear_svc(C: float, n_weight: float, max_iter: int = 100, parallelism: int = 8) -> OneVsRest:
    """One-vs-rest linear SVM; ``regParam = 1 / (C * sum(weights))`` matches the C-SVM
    objective ``C * sum(w_i hinge_i) + |w|^2 / 2``. The per-class binary fits run
    concurrently (``parallelism``) over the cached input."""
    svc = LinearSVC(regParam=1.0 / (C * n_weight), standardization=False, maxIter=max_iter, weightCol="weight")
    return OneVsRest(classifier=svc, featuresCol="features", labelCol="label", weightCol="weight", parallelism=parallelism)


# M3 ----------------------------------------------------------------------------------------------
def margins() -> SQLTransformer:
    """Renames a model's raw scores, so that a second model can follow in the pipeline."""
    return SQLTransformer(
        statement="SELECT * EXCEPT (rawPrediction, prediction), rawPrediction AS margins, prediction AS svc_prediction FROM __THIS__"
    )


def calibrate(model, held_out: DataFrame) -> PipelineModel:
    """OvR margins -> multinomial logistic regression -> class probabilities, as one savable pipeline."""
    rename = margins()
    scored = rename.transform(model.transform(held_out))
    lr = LogisticRegression(featuresCol="margins", labelCol="label", family="multinomial", regParam=1e-3)
    return PipelineModel(stages=[model, rename, lr.fit(scored)])


# M4 ----------------------------------------------------------------------------------------------
class ForestModel(RandomForestClassificationModel):
    """A fitted forest whose Python side does not hold its trees.

    ``Params.params`` reads every attribute but properties whenever a model is made or copied; the cached ``trees``
    of the parent then makes a Python object for each tree, which takes longer than the fit.
    """

    @property
    def trees(self) -> list:
        return [DecisionTreeClassificationModel(t) for t in self._call_java("trees")]


class Forest(RandomForestClassifier):
    def _create_model(self, java_model) -> ForestModel:
        return ForestModel(java_model)


def random_forest(num_trees: int = 100, max_depth: int = 4, seed: int = 42) -> RandomForestClassifier:
    return Forest(numTrees=num_trees, maxDepth=max_depth, seed=seed, weightCol="weight", featuresCol="features", labelCol="label")


# M5 ----------------------------------------------------------------------------------------------
def sample_grid(grid: list, n_iter: int, seed: int = 42) -> list:
    """Random search: ``n_iter`` distinct points of the grid (all of them if fewer)."""
    if len(grid) <= n_iter:
        return list(grid)
    return random.Random(seed).sample(list(grid), n_iter)


def tune(estimator, grid: list, df: DataFrame, n_iter: int = 10, k: int = 5, seed: int = 42, parallelism: int = 8, metric: str = "accuracy"):
    """M5: (best model, best mean CV score, best params) over a random sample of the grid.

    Folds are stratified by label (``fold`` column) so every class is in every fold. As ``CrossValidator`` does,
    each point is fitted without each fold and scored on it, but no fold waits for the last fit of another:
    ``parallelism`` of all (fold, point) fits run at a time, over rows that are held once.
    """
    folded = df if "fold" in df.columns else assign_folds(df, "label", key="doc_id", k=k, seed=seed)
    held = folded.select("*").persist()
    maps = sample_grid(grid, n_iter, seed)
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
    sizes = {r["fold"]: r["count"] for r in held.groupBy("fold").count().collect()}  # a row for each fold
    if set(sizes) != set(range(k)) or len(sizes) < 2:
        raise ValueError(f"{k} folds need rows in each, found rows by fold {sizes}")

    def score(fold_and_point: tuple[int, int]) -> float:
        i, j = fold_and_point
        model = estimator.fit(held.where(F.col("fold") != i), maps[j])
        return ev.evaluate(model.transform(held.where(F.col("fold") == i), maps[j]))

    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(df.sparkSession)(score), [(i, j) for i in range(k) for j in range(len(maps))], chunksize=1)
    means = np.mean(np.reshape(scores, (k, len(maps))), axis=0)
    best = int(np.argmax(means))
    params = {p.name: v for p, v in maps[best].items()}
    held.unpersist()
    model = estimator.fit(folded, maps[best])  # a forest depends on the partitions, which are not those of held rows
    return model, float(means[best]), params


def svc_grid(n_weight: float, Cs=(0.5, 0.75, 1.0)):
    base = linear_svc(1.0, n_weight)
    inner = base.getClassifier()
    return base, ParamGridBuilder().addGrid(inner.regParam, [1.0 / (c * n_weight) for c in Cs]).build()


def rf_grid(trees=(100, 200, 300), depths=(2, 3, 4), seed: int = 42):
    rf = random_forest(seed=seed)
    return rf, ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.maxDepth, list(depths)).build()


# M6 ----------------------------------------------------------------------------------------------
def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


# M8 ----------------------------------------------------------------------------------------------
def batch_score(
    df: DataFrame, input_col: str, make_scorer, dim: int, out_col: str = "logits", batch_bytes: int = 8 << 20
) -> DataFrame:
    """Score batches of array<double> inputs of length ``dim`` with a model that each worker loads once.

    ``make_scorer()`` runs in the worker, where it builds or loads the model, and returns a function from
    float64 [n, dim] to scores [n, k] (``predict_batch_udf`` keeps it for all batches of the worker).
    Batches are bounded by ``batch_bytes`` of input. Adds ``out_col`` (array<double>) and ``prediction``, the
    arg-max, which is a JVM expression.
    """

    def make():
        scorer = make_scorer()
        return lambda x: np.asarray(scorer(np.asarray(x, np.float64).reshape(-1, dim)), np.float64)

    score = predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=max(1, batch_bytes // (8 * dim)), input_tensor_shapes=[[dim]])
    return df.withColumn(out_col, score(F.col(input_col))).withColumn("prediction", EV.argmax(F.col(out_col)))


def linear_scorer(coefficients: np.ndarray, intercepts: np.ndarray):
    """A ``make_scorer`` for the linear model of a fitted classifier; the matrix travels in the closure."""

    def make():
        return lambda x: x @ coefficients.T + intercepts

    return make


# nearest centroid --------------------------------------------------------------------------------
def fit_centroids(df: DataFrame, label: str, vec: str, dim: int) -> DataFrame:
    """(class, centroid): the mean vector of each class, one aggregate for all dimensions."""
    means = [F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(dim)]
    return df.groupBy(F.col(label).alias("class")).agg(*means).select("class", F.array(*[F.col(f"m{i}") for i in range(dim)]).alias("centroid"))


def centroid_scores(df: DataFrame, centroids: DataFrame, vec: str, out_col: str = "logits") -> DataFrame:
    """Adds minus the squared distance to every centroid, in the order of classes.

    The centroids are one row (classes x dimensions numbers), which is what is broadcast.
    """
    row = centroids.agg(F.sort_array(F.collect_list(F.struct("class", "centroid"))).alias("__c"))

    def score(c: Column) -> Column:
        squares = F.zip_with(F.col(vec), c["centroid"], lambda x, m: (x - m) * (x - m))
        return -F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)

    return df.join(F.broadcast(row)).withColumn(out_col, F.transform("__c", score)).drop("__c")


# M9 / M7 -----------------------------------------------------------------------------------------
def evaluate_predictions(pred: DataFrame) -> dict:
    m = EV.macro_metrics(pred.select(F.col("label").cast("int"), F.col("prediction").cast("int"))).first()
    rep = EV.class_report(pred.select(F.col("label").cast("int"), F.col("prediction").cast("int")))
    wf1 = rep.where(F.col("row") == "weighted avg").first()["f1"]
    return {"accuracy": m["accuracy"], "macro_f1": m["f1"], "weighted_f1": wf1}


def fit_classifier(kind: str, train: DataFrame, n_weight: float | None = None, **kw):
    if kind == "nb":
        return naive_bayes(kw.get("smoothing", 1.0)).fit(train)
    if kind == "svc":
        return linear_svc(kw.get("C", 1.0), n_weight or float(train.count()), kw.get("max_iter", 100)).fit(train)
    if kind == "rf":
        return random_forest(kw.get("num_trees", 100), kw.get("max_depth", 4), kw.get("seed", 42)).fit(train)
    raise ValueError(f"unknown classifier {kind}")
