"""Model queries (rows-only checks): word vectors (F1, F2, F5), classifiers (M1-M9), topic
models (C1-C3, C6, C8, C9) and file round trips (S1-S9)."""

from __future__ import annotations

import itertools

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from revlens.operators import classify as CL
from revlens.operators import embed as EM
from revlens.operators import gsdmm as GS
from revlens.operators import lda as LD
from revlens.operators import ngrams as NG
from revlens.operators import pairwise as PW
from revlens.operators import split as S
from revlens.operators import subword as SW
from revlens.operators import svd as LS
from revlens.operators import tokens as K
from revlens.operators import topics as TP
from revlens.operators import vocab as V
from revlens.plans.q_corpus import labelled_tokens
from revlens.plans.q_text import clean_tokens, pos_table
from revlens.plans.registry import query
from revlens.session import scratch_path
from revlens.sources import files as FS
from revlens.sources.registry import log_run, new_run_id, resolve_model_path
from revlens.sources.tables import read_table
from revlens.workflows import materialize

W2V_DIM = 100


# F1 / F2 / F5 ------------------------------------------------------------------------------------
def _w2v(spark, sf):
    model = EM.train_word2vec(clean_tokens(spark, sf), "toks", vector_size=W2V_DIM, window=5, min_count=5, seed=42)
    return EM.word_vectors(model)


@query("word2vec")
def q_word2vec(spark, sf):
    """F1 + S8: train, write the vectors in word2vec text format, read them back."""
    path = scratch_path(spark, "w2v-" + new_run_id())
    FS.write_word_vectors_text(_w2v(spark, sf), path)
    return FS.read_word_vectors_text(spark, path, header=False)


def _subword(spark, sf, toks, epochs=5):
    """Trained sub-word vectors of every word of ``toks``, rare ones included."""
    model = SW.train_subword(clean_tokens(spark, sf), "toks", dim=W2V_DIM, window=5, min_count=5, epochs=epochs, seed=42)
    return SW.subword_embeddings(model, toks.select(F.explode("toks").alias("word")))


@query("subword_lookup")
def q_subword_lookup(spark, sf):
    return _subword(spark, sf, clean_tokens(spark, sf))


@query("embed_splits")
def q_embed_splits(spark, sf):
    """mean-pooled (w2v) and IDF-pooled (sub-word) embeddings of every split; the IDF is
    fitted on the training split only."""
    toks = S.split_exact(labelled_tokens(spark, sf))
    vecs = _w2v(spark, sf)
    mean = EM.mean_pool(toks, "doc_id", "toks", vecs, W2V_DIM).select("doc_id", "split", "sentiment", F.col("embeds").alias("w2v_mean"))
    train = toks.where(F.col("split") == "train")
    idf = V.smooth_idf(train, "doc_id", "toks")
    tfidf = EM.idf_pool(toks, "doc_id", "toks", _subword(spark, sf, toks), idf, W2V_DIM).select("doc_id", F.col("embeds").alias("ft_tfidf"))
    return mean.join(tfidf, "doc_id")


# classifier inputs ----------------------------------------------------------------------------------
def embedded_sets(spark, sf):
    """The supplied embeddings as (doc_id, label, features, weight, split)."""
    e = read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("embeds")
    )
    e = S.split_threshold(EM.features(e))
    return CL.fit_input(CL.balanced(e))  # iterative fits read it many times


def review_sets(spark, sf):
    lt = labelled_tokens(spark, sf).withColumnRenamed("sentiment", "label")
    return CL.fit_input(CL.balanced(S.split_threshold(lt), "label"))  # iterative fits read it many times


def _train_test(df):
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


def _pred_cols(p):
    return p.select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"))


# M1 ----------------------------------------------------------------------------------------------
@query("naive_bayes")
def q_naive_bayes(spark, sf):
    train, test = _train_test(review_sets(spark, sf))
    feats = CL.SmoothTfidf(inputCol="toks", outputCol="features").fit(train)
    model = CL.naive_bayes().fit(feats.transform(train))
    return _pred_cols(model.transform(feats.transform(test)))


# M2 ----------------------------------------------------------------------------------------------
@query("linear_svc")
def q_linear_svc(spark, sf):
    train, test = _train_test(embedded_sets(spark, sf))
    model = CL.linear_svc(1.0, float(train.agg(F.sum("weight")).first()[0])).fit(train)
    return _pred_cols(model.transform(test))


# M3 ----------------------------------------------------------------------------------------------
@query("svc_proba")
def q_svc_proba(spark, sf):
    sets = CL.fit_input(S.carve_validation(embedded_sets(spark, sf), frac=0.2))
    train, test = _train_test(sets)
    held = sets.where(F.col("split") == "validation")
    base = CL.linear_svc(1.0, float(train.agg(F.sum("weight")).first()[0])).fit(train)
    cal = CL.calibrate(base, held)
    out = cal.transform(test)
    from pyspark.ml.functions import vector_to_array

    return out.select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability").alias("probability"))


@query("pairwise_svc")
def q_pairwise_svc(spark, sf):
    """M2 + M3 as pairwise models: votes, coupled Platt probabilities, saved and loaded."""
    train, test = _train_test(embedded_sets(spark, sf))
    model = PW.fit_pairwise_svc(train, "label", "embeds", 64, C=1.0, weight="weight", folds=5)
    model = PW.load_pairwise(spark, PW.save_pairwise(spark, model, scratch_path(spark, "pairwise-" + new_run_id())))
    return PW.predict_pairwise(test.select("doc_id", "label", "embeds"), model, "embeds").drop("embeds")


# M4 ----------------------------------------------------------------------------------------------
@query("random_forest")
def q_random_forest(spark, sf):
    train, test = _train_test(embedded_sets(spark, sf))
    return _pred_cols(CL.random_forest(100, 4).fit(train).transform(test))


# M5 ----------------------------------------------------------------------------------------------
@query("tune")
def q_tune(spark, sf):
    train, _ = _train_test(embedded_sets(spark, sf))
    est, grid = CL.rf_grid()
    model, score, params = CL.tune(est, grid, train.cache(), n_iter=10, k=5)
    rows = [(k, str(v)) for k, v in sorted(params.items())] + [("best_cv_accuracy", f"{score:.6f}")]
    return spark.createDataFrame(rows, "name string, value string")


# M6 / S9 / S10 -------------------------------------------------------------------------------------
@query("predict_saved")
def q_predict_saved(spark, sf):
    train, test = _train_test(embedded_sets(spark, sf))
    model = CL.random_forest(100, 4).fit(train)
    root = scratch_path(spark, "models-" + new_run_id())
    run = new_run_id()
    path = FS.save_model(model, f"{root}/random_forest/{run}")
    log_run(spark, root, "random_forest", run, {"numTrees": 100, "maxDepth": 4}, {("train", "rows"): float(train.count())}, path)
    loaded = FS.load_model(RandomForestClassificationModel, resolve_model_path(spark, root, "random_forest"))
    return _pred_cols(CL.predict(loaded, test))


# M7 -----------------------------------------------------------------------------------------------
@query("train_predict")
def q_train_predict(spark, sf):
    """M7 + M6: a forest and a pairwise SVC tuned on embeddings of all classes, saved, reloaded and applied."""
    from revlens.workflows import predict_latest, train_classifier

    e = read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("embeds")
    )
    data = S.carve_validation(S.split_threshold(e), frac=0.2)
    root = scratch_path(spark, "train-" + new_run_id())
    test = data.where("split = 'test'")
    train_classifier(spark, data, root, kind="rf", features="embeds")
    forest, _ = predict_latest(spark, root, "rf", test)
    held = CL.fit_input(CL.balanced(data))
    model, _, _ = PW.tune_pairwise_svc(held.where("split = 'train'"), "label", "embeds", 64, weight="weight")
    model = PW.load_pairwise(spark, PW.save_pairwise(spark, model, f"{root}/pairwise"))
    votes = PW.predict_pairwise(test, model, "embeds")
    return _pred_cols(forest).withColumn("model", F.lit("rf")).unionByName(_pred_cols(votes).withColumn("model", F.lit("svc")))


# M8 ----------------------------------------------------------------------------------------------
@query("batch_score")
def q_batch_score(spark, sf):
    """Every embedding scored in batches by a logistic regression fitted on the training rows."""
    from pyspark.ml.classification import LogisticRegression

    sets = embedded_sets(spark, sf)
    model = LogisticRegression(maxIter=50, regParam=0.01, weightCol="weight").fit(sets.where("split = 'train'"))
    make = CL.linear_scorer(model.coefficientMatrix.toArray(), model.interceptVector.toArray())
    return CL.batch_score(sets, "embeds", make, model.numFeatures).select(F.col("doc_id").alias("vec_id"), "label", "prediction")


# M9 ----------------------------------------------------------------------------------------------
@query("model_matrix")
def q_model_matrix(spark, sf):
    """Feature x classifier comparison on the labelled reviews: TF-IDF, and trained word and sub-word
    vectors with mean and IDF pooling; the IDF is fitted on the training rows."""
    sets = review_sets(spark, sf)
    train, test = _train_test(sets)
    tfidf = CL.SmoothTfidf(inputCol="toks", outputCol="features").fit(train)
    feature_sets = {"tfidf": (tfidf.transform(train), tfidf.transform(test))}
    idf = V.smooth_idf(train, "doc_id", "toks")
    for name, vectors in (("w2v", _w2v(spark, sf)), ("subword", _subword(spark, sf, sets, epochs=1))):
        held = vectors.persist()
        for how, pooled in (("mean", EM.mean_pool(sets, "doc_id", "toks", held, W2V_DIM)), ("idf", EM.idf_pool(sets, "doc_id", "toks", held, idf, W2V_DIM))):
            feature_sets[f"{name}_{how}"] = _train_test(CL.fit_input(EM.features(pooled.select("doc_id", "label", "weight", "split", "embeds"))))
    n_weight = float(train.agg(F.sum("weight")).first()[0])
    rows = []
    for fname, (tr, te) in feature_sets.items():
        for kind in ("nb", "svc", "rf"):
            if kind == "nb" and fname != "tfidf":
                continue
            model = CL.fit_classifier(kind, tr, n_weight=n_weight, num_trees=100, max_depth=4)
            m = CL.evaluate_predictions(model.transform(te))
            rows.append((fname, kind, m["accuracy"], m["macro_f1"], m["weighted_f1"]))
    sets.unpersist()
    return spark.createDataFrame(rows, "features string, model string, accuracy double, macro_f1 double, weighted_f1 double")


# topic models --------------------------------------------------------------------------------------
CLASSES = (0, 1, 2)


def _class_corpora(spark, sf):
    lt = labelled_tokens(spark, sf).cache()
    voc = V.filter_extremes(lt, "doc_id", "toks", ["sentiment"]).cache()
    out = {}
    for c in CLASSES:
        docs = lt.where(F.col("sentiment") == c)
        v = voc.where(F.col("sentiment") == c)
        terms = TP.vocab_list(v)
        n = docs.count()
        counts = TP.count_vectors(docs, "toks", terms) if terms else None
        dt = docs.select("doc_id", F.explode(F.array_distinct("toks")).alias("term"))
        out[c] = (docs, v, terms, n, counts, dt)
    return out


def _with_terms(spark, sf):
    """The classes that have a vocabulary; the others have no topics to list."""
    return {c: x for c, x in _class_corpora(spark, sf).items() if x[2]}


def _union(spark, parts, schema):
    """All parts; a table without rows if there are none."""
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    return out


@query("lda")
def q_lda(spark, sf):
    parts = []
    for c, (_, _, terms, n, counts, dt) in _with_terms(spark, sf).items():
        m = TP.fit_lda(counts, 10, "symmetric", "symmetric")
        parts.append(TP.lda_topics(m, spark, terms, 20).withColumn("sentiment", F.lit(c)))
    return _union(spark, parts, "topic int, rank int, term string, weight double, sentiment int")


@query("doc_topics")
def q_doc_topics(spark, sf):
    """Every labelled document; those of a class without a vocabulary get the uniform mixture."""
    parts = []
    for c, (docs, _, terms, n, counts, _) in _class_corpora(spark, sf).items():
        if not terms:
            uniform = docs.select("doc_id", F.array_repeat(F.lit(0.1), 10).alias("mixture"), F.lit(0).alias("topic"))
            parts.append(uniform.withColumn("sentiment", F.lit(c)))
            continue
        m = TP.fit_lda(counts, 10, "symmetric", "symmetric")
        parts.append(TP.doc_topics(m, counts).withColumn("sentiment", F.lit(c)))
    return _union(spark, parts, "doc_id bigint, mixture array<double>, topic int, sentiment int")


LSI_K = 10


def _tfidf_entries(lt):
    """(sentiment, doc_id, term, weight) over the vocabulary of each class, which no list on the driver holds."""
    voc = V.filter_extremes(lt, "doc_id", "toks", ["sentiment"])
    bow = materialize(V.bag_of_words(lt, "doc_id", "toks", voc, ["sentiment"]), "lsi-bags")  # read twice
    n_docs = lt.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n_docs"))
    return V.tfidf_topic(bow, n_docs, "doc_id", ["sentiment"]), n_docs


@query("lsi")
def q_lsi(spark, sf):
    entries, _ = _tfidf_entries(labelled_tokens(spark, sf))
    return LS.lsi_topics(LS.fit_lsi(entries, "sentiment", "doc_id", "term", "weight", LSI_K), "term", 20)


@query("lsi_fold_in")
def q_lsi_fold_in(spark, sf):
    """S9 + C2: LSI of the training documents, saved, loaded and applied to the other documents."""
    lt = S.split_threshold(labelled_tokens(spark, sf))
    train, test = lt.where("split = 'train'"), lt.where("split = 'test'")
    voc = materialize(V.filter_extremes(train, "doc_id", "toks", ["sentiment"]), "lsi-vocabulary")
    bow = materialize(V.bag_of_words(train, "doc_id", "toks", voc, ["sentiment"]), "lsi-bags")
    n_docs = train.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n_docs"))
    entries = V.tfidf_topic(bow, n_docs, "doc_id", ["sentiment"])
    model = LS.fit_lsi(entries, "sentiment", "doc_id", "term", "weight", LSI_K)
    if not model.singular:
        return spark.createDataFrame([], "sentiment int, doc_id bigint, coordinates array<double>")
    model = LS.load_lsi(spark, LS.save_lsi(model, scratch_path(spark, "lsi-" + new_run_id())))
    idf = bow.groupBy("sentiment", "term").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(n_docs), "sentiment")
    idf = idf.select("sentiment", "term", F.log2(F.col("n_docs") / F.col("df")).alias("idf"))
    new = V.bag_of_words(test, "doc_id", "toks", voc, ["sentiment"]).join(idf, ["sentiment", "term"])
    new = new.withColumn("weight", F.col("tf") * F.col("idf"))
    norm = new.groupBy("sentiment", "doc_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")).where("norm > 0")
    new = new.join(norm, ["sentiment", "doc_id"]).withColumn("weight", F.col("weight") / F.col("norm"))
    return LS.fold_in(model, new, "doc_id", "term", "weight")


@query("lda_grid")
def q_lda_grid(spark, sf):
    """All 120 points of every class, fitted in the same passes."""
    lt = materialize(labelled_tokens(spark, sf), "grid-tokens")
    voc, docs = _bags(lt)
    voc = materialize(voc, "grid-vocabulary")
    dt = lt.select("sentiment", "doc_id", F.explode(F.array_distinct("toks")).alias("term")).join(voc.select("sentiment", "term"), ["sentiment", "term"], "left_semi")
    points = [LD.LdaPoint(k, a, b) for k, a, b in itertools.product(TP.LDA_TOPICS, TP.LDA_ALPHAS, TP.LDA_BETAS)]
    return LD.grid(docs, "sentiment", voc, dt, V.doc_counts(lt, ["sentiment"]), points, passes=10)


def _topic_chain(spark, sf):
    """Labelled documents through parts of speech, bigrams, trigrams and TF-IDF: (vocabulary, weighted bags)."""
    lt = labelled_tokens(spark, sf)
    kept = K.filter_pos(lt, "doc_id", "toks", pos_table(lt), ("NOUN", "VERB", "PROPN"), out_col="kept").select("doc_id", "sentiment", "kept")
    kept = materialize(kept, "chain-kept")
    two = materialize(NG.bigrams(kept, "doc_id", "kept", "two").select("doc_id", "sentiment", "two"), "chain-bigrams")
    toks = materialize(NG.trigrams(two, "doc_id", "two", "three").select("doc_id", "sentiment", F.col("three").alias("toks")), "chain-trigrams")
    voc = materialize(V.filter_extremes(toks, "doc_id", "toks", ["sentiment"]), "chain-vocabulary")
    entries = V.tfidf_topic(V.bag_of_words(toks, "doc_id", "toks", voc, ["sentiment"]), V.doc_counts(toks, ["sentiment"]), "doc_id", ["sentiment"])
    pairs = entries.groupBy("sentiment", "doc_id").agg(F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("p"))
    docs = toks.select("sentiment", "doc_id").join(pairs, ["sentiment", "doc_id"], "left")
    return voc, docs.select("sentiment", "doc_id", F.col("p.term_id").alias("ids"), F.col("p.weight").alias("cnts"))


@query("lda_chain")
def q_lda_chain(spark, sf):
    """C1 + C12: the whole chain to topics of TF-IDF weights with learnt priors; each topic's prevalence and most
    relevant words."""
    voc, docs = _topic_chain(spark, sf)
    models = LD.fit(docs, "sentiment", [LD.LdaPoint(10, "auto", "auto")])
    return LD.relevant_words(models, voc).drop("model")


@query("lda_fold_in")
def q_lda_fold_in(spark, sf):
    """C1 + C6 + S9: LDA with learnt priors of the training documents, saved, loaded and applied to the others."""
    lt = S.split_threshold(labelled_tokens(spark, sf))
    train, test = lt.where("split = 'train'"), lt.where("split = 'test'")
    voc, docs = _bags(train)
    models = LD.fit(docs, "sentiment", [LD.LdaPoint(10, "auto", "auto_symmetric")])
    models = LD.load(spark, LD.save(models, scratch_path(spark, "lda-" + new_run_id())))
    bags = V.bag_of_words(test, "doc_id", "toks", voc, ["sentiment"]).groupBy("sentiment", "doc_id").agg(F.collect_list(F.struct("term_id", "tf")).alias("p"))
    new = test.select("sentiment", "doc_id").join(bags, ["sentiment", "doc_id"], "left").select(
        "sentiment", "doc_id", F.col("p.term_id").alias("ids"), F.col("p.tf").alias("cnts")
    )
    return LD.mixtures(models, new).drop("model")


@query("lsi_grid")
def q_lsi_grid(spark, sf):
    lt = labelled_tokens(spark, sf)
    entries, n_docs = _tfidf_entries(lt)
    model = LS.fit_lsi(entries, "sentiment", "doc_id", "term", "weight", 12)
    dt = lt.select("sentiment", "doc_id", F.explode(F.array_distinct("toks")).alias("term"))
    return TP.lsi_grid(model, dt, n_docs, range(2, 13))


def _bags(lt):
    """Vocabulary by class, and the bags of words of all documents; some have no word of the vocabulary."""
    voc = materialize(V.filter_extremes(lt, "doc_id", "toks", ["sentiment"]), "bags-vocabulary")  # read twice or more
    bow = V.bag_of_words(lt, "doc_id", "toks", voc, ["sentiment"])
    grouped = bow.groupBy("sentiment", "doc_id").agg(F.sort_array(F.collect_list(F.struct("term_id", "tf"))).alias("p"))
    docs = lt.select("sentiment", "doc_id").join(grouped, ["sentiment", "doc_id"], "left").select(
        "sentiment", "doc_id",
        F.coalesce(F.col("p.term_id"), F.array().cast("array<int>")).alias("ids"),
        F.coalesce(F.col("p.tf").cast("array<int>"), F.array().cast("array<int>")).alias("cnts"),
    )
    return voc, docs


def _fit_gsdmm(lt, voc, docs):
    """K = 2 for negative, 8 otherwise; alpha = beta = 0.1; 100 sweeps."""
    vs = {r["sentiment"]: r["v"] for r in voc.groupBy("sentiment").agg(F.count(F.lit(1)).alias("v")).collect()}
    vs = {r["sentiment"]: vs.get(r["sentiment"], 0) for r in lt.select("sentiment").distinct().collect()}
    ks = {c: (2 if c == 0 else 8) for c in vs}
    return GS.fit_gsdmm(docs, "sentiment", ks, vs, 0.1, 0.1, 100, seed=42)


@query("gsdmm")
def q_gsdmm(spark, sf):
    """MGP of all classes at once."""
    lt = labelled_tokens(spark, sf)
    assign, _ = _fit_gsdmm(lt, *_bags(lt))
    return assign.withColumnRenamed("z", "cluster")


@query("gsdmm_fold_in")
def q_gsdmm_fold_in(spark, sf):
    """S9 + C3: MGP of the training documents, saved, loaded and applied to the other documents."""
    lt = S.split_threshold(labelled_tokens(spark, sf))
    train = lt.where("split = 'train'")
    voc, docs = _bags(train)
    _, model = _fit_gsdmm(train, voc, docs)
    model = GS.load_gsdmm(spark, GS.save_gsdmm(model, scratch_path(spark, "gsdmm-" + new_run_id())))
    test = lt.where("split = 'test'").join(F.broadcast(spark.createDataFrame([(c,) for c in model.clusters], "sentiment int")), "sentiment")
    bow = V.bag_of_words(test, "doc_id", "toks", voc, ["sentiment"])
    bags = bow.groupBy("sentiment", "doc_id").agg(F.collect_list(F.struct("term_id", "tf")).alias("p"))
    new = test.select("sentiment", "doc_id").join(bags, ["sentiment", "doc_id"], "left").select(
        "sentiment", "doc_id", F.col("p.term_id").alias("ids"), F.col("p.tf").cast("array<int>").alias("cnts")
    )
    return GS.fold_in(model, new).withColumnRenamed("z", "cluster")


# S1-S7 ---------------------------------------------------------------------------------------------
@query("split_roundtrip")
def q_split_roundtrip(spark, sf):
    """Write the exact split as partitioned Parquet, CSV (raw dotted names) and JSON; read
    each back and count rows per split and format."""
    from revlens.sources.tables import reviews

    r = S.split_exact(reviews(spark, sf)).select(
        F.col("doc_id").cast("string").alias("id"), F.col("brand").alias("name"), "brand",
        F.col("category").alias("primaryCategories"), F.col("rating").alias("reviews.rating"),
        F.col("text").alias("reviews.text"), F.lit(None).cast("string").alias("reviews.title"),
        F.lit(None).cast("boolean").alias("reviews.didPurchase"), F.lit(None).cast("boolean").alias("reviews.doRecommend"),
        F.lit(None).cast("string").alias("reviews.id"), "split",
    )
    root = scratch_path(spark, "splits-" + new_run_id())
    out = None
    for fmt in ("parquet", "csv", "json"):
        FS.write_splits(r, f"{root}/{fmt}", fmt)
        if fmt == "csv":
            back = FS.read_splits(spark, f"{root}/{fmt}", "csv", FS.RAW_REVIEW_SCHEMA + ", split string")
            back = FS.canonical_names(back)
        else:
            back = FS.canonical_names(FS.read_splits(spark, f"{root}/{fmt}", fmt))
        counts = back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
        counts = counts.withColumn("format", F.lit(fmt))
        out = counts if out is None else out.unionByName(counts)
    # CSV sink of token arrays (JSON text in a cell), parsed back with S4
    toks = S.split_exact(clean_tokens(spark, sf))
    FS.write_csv(toks.select("doc_id", "split", "toks"), f"{root}/tokens_csv")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{root}/tokens_csv")
    back = back.withColumn("toks", F.from_json("toks", "array<string>"))
    counts = back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("toks")).alias("chars")).withColumn("format", F.lit("csv_tokens"))
    return out.unionByName(counts)


# E5 (importances) -----------------------------------------------------------------------------------
@query("feature_importance")
def q_feature_importance(spark, sf):
    from revlens.operators.evaluate import feature_importance

    train, _ = _train_test(embedded_sets(spark, sf))
    model = CL.random_forest(100, 4).fit(train)
    return feature_importance(spark, model, [f"dim{i}" for i in range(model.numFeatures)], top=20)
