"""Workflows (dataset preparation, training, prediction) and the streaming wrapper, at sf0.001."""

import tempfile

from pyspark.sql import functions as F

from revlens import workflows as WF
from revlens.sources.tables import reviews
from revlens.streaming import score_stream

from .conftest import SF0001


def test_prepare_train_predict(spark):
    out = tempfile.mkdtemp(prefix="revlens-prep-")
    prepared = WF.prepare_dataset(reviews(spark, SF0001), out + "/data")
    sizes = {r["split"]: r["count"] for r in prepared.groupBy("split").count().collect()}
    assert set(sizes) <= {"train", "validation", "test"} and sum(sizes.values()) == prepared.count()
    # partition pruning on split
    plan = prepared.where(F.col("split") == "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    data = prepared.withColumnRenamed("labels", "label")
    res = WF.train_classifier(spark, data, out + "/registry", kind="nb", features="tfidf")
    assert 0.0 <= res["accuracy"] <= 1.0
    pred, cm = WF.predict_latest(spark, out + "/registry", "nb", data.where(F.col("split") == "test"))
    assert cm.agg(F.sum("n")).first()[0] == pred.count()


def test_score_stream(spark):
    out = tempfile.mkdtemp(prefix="revlens-stream-")
    prepared = WF.prepare_dataset(reviews(spark, SF0001), out + "/data")
    data = prepared.withColumnRenamed("labels", "label")
    res = WF.train_classifier(spark, data, out + "/registry", kind="nb", features="tfidf")
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(res["path"])
    src = spark.read.parquet(f"{SF0001}/documents.parquet")
    src.write.mode("overwrite").parquet(out + "/incoming")  # a file-stream source is a folder
    stream = spark.readStream.schema(src.schema).parquet(out + "/incoming")
    # the fitted pipeline reads "tokens"
    q = score_stream(stream, model, out + "/scored", out + "/ckpt")
    q.awaitTermination(120)
    scored = spark.read.parquet(out + "/scored")
    assert scored.count() == spark.read.parquet(f"{SF0001}/documents.parquet").count()


def test_tune_topics_refits_best(spark):
    from revlens.plans.q_corpus import labelled_tokens

    from .conftest import SF001

    out = tempfile.mkdtemp(prefix="revlens-topics-")
    docs = labelled_tokens(spark, SF001).withColumnRenamed("toks", "tokens")
    grid = WF.tune_topics(spark, docs, ks=[2, 3], alphas=["symmetric"], betas=[0.5], model_root=out + "/lda")
    rows = grid.collect()
    assert rows and all(r["coherence"] is not None for r in rows)
    assert {r["num_topics"] for r in rows} == {2, 3}
    from pyspark.ml.clustering import LocalLDAModel

    saved = [r["sentiment"] for r in grid.select("sentiment").distinct().collect()]
    m = LocalLDAModel.load(f"{out}/lda/lda_{saved[0]}")
    assert m.getK() in (2, 3)


def test_prepare_drops_empty_texts_from_the_text_form(spark):
    out = tempfile.mkdtemp(prefix="revlens-forms-")
    rows = spark.createDataFrame([(i, "!!!" if i % 2 else "good phone", 5) for i in range(20)], "doc_id long, text string, rating int")
    assert WF.prepare_dataset(rows, out + "/text").count() == 10
    tokens = WF.prepare_dataset(rows, out + "/tokens", form="tokens")
    assert tokens.count() == 20 and tokens.where(F.size("tokens") == 0).count() == 10


def test_train_and_predict_on_embeddings(spark):
    out = tempfile.mkdtemp(prefix="revlens-embeds-")
    rows = [(i, i % 2, [float(i % 2) + (i % 7) * 0.01, 1.0], ("train", "train", "train", "validation", "test")[i % 5]) for i in range(100)]
    data = spark.createDataFrame(rows, "doc_id long, label int, embeds array<double>, split string")
    for kind in ("svc", "rf"):
        got = WF.train_classifier(spark, data, out + "/registry", kind=kind, features="embeds", n_iter=1, folds=2)
        assert got["accuracy"] == 1.0
        stored = spark.read.parquet(got["reports"] + "/predictions")
        assert stored.count() == 20 and stored.where(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).isEmpty()
        pred, _ = WF.predict_latest(spark, out + "/registry", kind, data.where("split = 'test'"), out_path=out + "/" + kind)
        assert pred.where("label <> prediction").isEmpty() and spark.read.parquet(out + "/" + kind).count() == 20
