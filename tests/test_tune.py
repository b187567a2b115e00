"""Forests without Python trees, and tuning against Spark's CrossValidator."""

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from revlens.operators import classify as CL
from revlens.operators.split import assign_folds


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, (rng.normal(size=4) + np.eye(3, 4)[i % 3]).tolist(), 1.0 + i % 2) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<double>, weight double").repartition(2, "doc_id")
    return df.withColumn("features", array_to_vector("x")).cache()


def test_fitted_forest_makes_no_python_trees(data):
    model = CL.random_forest(5, 2).fit(data)
    copied = model.copy({model.getParam("maxDepth"): 2})
    assert "trees" not in model.__dict__ and "trees" not in copied.__dict__
    assert len(model.trees) == 5 and all(t.depth <= 2 for t in model.trees)


def test_tune_scores_like_cross_validator(data):
    est, grid = CL.rf_grid(trees=(2, 4), depths=(1, 3))
    folded = assign_folds(data, "label", k=3)
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    stock = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, numFolds=3, foldCol="fold").fit(folded)
    model, score, params = CL.tune(est, grid, data, k=3)
    best = int(np.argmax(stock.avgMetrics))
    assert score == pytest.approx(stock.avgMetrics[best], abs=1e-12)
    assert params == {p.name: v for p, v in grid[best].items()}
    both = [m.transform(data).select("doc_id", "prediction").orderBy("doc_id").collect() for m in (model, stock.bestModel)]
    assert both[0] == both[1]


def test_tune_needs_rows_in_every_fold(data):
    with pytest.raises(ValueError, match="folds"):
        CL.tune(CL.naive_bayes(), [{}], data.withColumn("fold", F.lit(0)), k=2)
