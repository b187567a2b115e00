"""End-to-end flows of the reviewed project, re-expressed as Spark jobs.

* :func:`prepare_dataset` (dataset preparation): read reviews, exact 81/9/10 split, clean once,
  recode labels, drop incomplete rows, write one split-partitioned dataset holding both the
  token form and the joined-text form (the reference cleaned twice for the two forms).
* :func:`create_embeddings` (F5 + S7): pooled embeddings of every split, IDF fitted on train.
* :func:`train_classifier` (M7): tune on train, validate, report, save, log a run.
* :func:`predict_latest` (M6 + S10): the latest (or an explicit) model applied to a split.
* :func:`tune_topics` (C8 / C9 / C10): per-class grid, UMass table, refit of the best model.

Intermediate results that are read more than once are written to the shared checkpoint
folder (``spark.checkpoint.dir``) rather than kept in executor memory, so a lost executor
costs a re-read, not a recomputation of the whole lineage.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import classify as CL
from revlens.operators import embed as EM
from revlens.operators import evaluate as EV
from revlens.operators import profile as P
from revlens.operators import split as S
from revlens.operators import topics as TP
from revlens.operators import vocab as V
from revlens.session import scratch_path
from revlens.sources import files as FS
from revlens.sources.registry import log_run, new_run_id, resolve_model_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{new_run_id()}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def prepare_dataset(
    reviews: DataFrame,
    out_path: str,
    label_map: dict | None = None,
    opts: T.CleanOptions = T.CleanOptions(),
    key: str = "doc_id",
    seed: int = 42,
    form: str = "text",
) -> DataFrame:
    """reviews(key, text, rating) -> ``out_path`` partitioned by split with columns
    (key, tokens, text, rating, labels).

    ``form`` "text" drops rows whose cleaned text is empty (null ``text``, P7 / P8); "tokens" keeps them
    with an empty token list, as the token form of the reviewed project does.
    """
    if form not in ("text", "tokens"):
        raise ValueError(f"unknown form {form}")
    mapping = label_map or {1: 0, 2: 0, 3: 1, 4: 2, 5: 2}
    df = S.split_exact(reviews.select(key, "text", "rating"), key, seed)
    df = df.withColumn("tokens", T.clean_text(F.col("text"), opts)).drop("text")
    df = df.withColumn("text", F.nullif(T.join_tokens(F.col("tokens")), F.lit("")))
    df = P.recode_labels(df, mapping, "rating", "labels")
    df = P.drop_incomplete(df, subset=["labels", "text"] if form == "text" else ["labels"])
    FS.write_splits(df, out_path)
    return FS.read_splits(df.sparkSession, out_path)


def create_embeddings(splits: DataFrame, vectors: DataFrame, dim: int, mode: str = "mean", out_path: str | None = None,
                      key: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """``mode`` "mean" (F3) or "tfidf" (F4, IDF fitted on the train split only)."""
    if mode == "mean":
        out = EM.mean_pool(splits, key, tokens_col, vectors, dim)
    elif mode == "tfidf":
        train = splits.where(F.col("split") == "train")
        idf = V.smooth_idf(train, key, tokens_col)
        out = EM.idf_pool(splits, key, tokens_col, vectors, idf, dim)
    else:
        raise ValueError(f"unknown vectorisation mode {mode}")
    if out_path:
        FS.write_embedded(out, out_path)
    return out


def train_classifier(spark: SparkSession, data: DataFrame, registry_root: str, kind: str = "rf", features: str = "tfidf",
                     tokens_col: str = "tokens", n_iter: int = 10, seed: int = 42, folds: int = 5) -> dict:
    """M7: data has (doc_id, label, split, tokens | embeds).

    ``features`` is "tfidf" or the name of an embedding column. Weights and folds come from the training
    rows. An SVC is calibrated on the validation rows, so every saved model but naive Bayes' own gives
    probabilities. Predictions of the validation rows, with probabilities, and the class proportions of
    the training rows are written beside the model. Returns metrics and paths.
    """
    data = CL.fit_input(CL.balanced(data, "label"))
    train, val = data.where(F.col("split") == "train"), data.where(F.col("split") == "validation")
    stages = []
    if features == "tfidf":
        tf = CL.SmoothTfidf(inputCol=tokens_col, outputCol="features").fit(train)
        stages.append(tf)
        train, val = tf.transform(train), tf.transform(val)
    else:
        train, val = EM.features(train, features), EM.features(val, features)
    n_weight = float(train.agg(F.sum("weight")).first()[0])
    if kind == "rf":
        est, grid = CL.rf_grid(seed=seed)
    elif kind == "svc":
        est, grid = CL.svc_grid(n_weight)
    else:
        est, grid = CL.naive_bayes(), [{}]
    model, cv_score, params = CL.tune(est, grid, train, n_iter=n_iter, k=folds, seed=seed)
    if kind == "svc":
        model = CL.calibrate(model, val)
    scored = model.transform(val)
    metrics = CL.evaluate_predictions(scored)
    run = new_run_id()
    path = f"{registry_root.rstrip('/')}/{kind}/{run}"
    PipelineModel(stages=stages + [model]).write().overwrite().save(path)
    reports = f"{registry_root.rstrip('/')}/reports/{kind}-{run}"
    write_predictions(scored, f"{reports}/predictions")
    P.value_counts(train, "label").write.mode("overwrite").parquet(f"{reports}/class_counts")
    log_run(spark, registry_root, kind, run, params | {"features": features}, {("validation", k): v for k, v in metrics.items()} | {("train", "cv_accuracy"): cv_score}, path)
    data.unpersist()
    return {"run_id": run, "path": path, "reports": reports, "params": params, "cv_accuracy": cv_score, **metrics}


def write_predictions(scored: DataFrame, path: str) -> None:
    """(doc_id, label, prediction, probability) of scored rows as Parquet."""
    scored.select(
        "doc_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").alias("probability"),
    ).write.mode("overwrite").parquet(path)


def predict_latest(spark: SparkSession, registry_root: str, kind: str, data: DataFrame, path: str | None = None,
                   embeds_col: str = "embeds", out_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M6: (predictions, K x K confusion matrix) with the latest or an explicit model.

    Models trained on embeddings read ``embeds_col`` of ``data``. ``out_path`` also writes the predictions.
    """
    model = PipelineModel.load(resolve_model_path(spark, registry_root, kind, path))
    if "features" not in data.columns and embeds_col in data.columns:
        data = EM.features(data, embeds_col)
    if out_path:
        write_predictions(model.transform(data), out_path)
    pred = model.transform(data).withColumn("prediction", F.col("prediction").cast("int"))
    return pred, EV.confusion_matrix(pred.select(F.col("label").cast("int"), "prediction"))


def tune_topics(spark: SparkSession, docs: DataFrame, class_col: str = "sentiment", tokens_col: str = "tokens", frac: float = 0.75,
                model_root: str | None = None, ks=TP.LDA_TOPICS, alphas=TP.LDA_ALPHAS, betas=TP.LDA_BETAS) -> DataFrame:
    """C8 + C10 per class: grid on the first ``frac`` of the class corpus (hash order),
    scored by UMass, best model refitted on the whole class corpus and saved."""
    vocab = V.filter_extremes(docs, "doc_id", tokens_col, [class_col]).cache()
    results = None
    for c in [r[0] for r in docs.select(class_col).distinct().collect()]:  # a handful of classes
        part = docs.where(F.col(class_col) == c)
        terms = TP.vocab_list(vocab.where(F.col(class_col) == c))
        if not terms:
            continue
        clip = S.clip_corpus(part, frac)
        n_clip = clip.count()
        counts = TP.count_vectors(clip, tokens_col, terms)
        dt = clip.select("doc_id", F.explode(F.array_distinct(tokens_col)).alias("term"))
        grid = TP.lda_grid(spark, counts, dt, terms, n_clip, ks, alphas, betas).withColumn(class_col, F.lit(c))
        grid = materialize(grid, f"lda-grid-{c}")
        if model_root:
            TP.refit_best(grid, TP.count_vectors(part, tokens_col, terms), f"{model_root.rstrip('/')}/lda_{c}")
        results = grid if results is None else results.unionByName(grid)
    vocab.unpersist()
    return results
