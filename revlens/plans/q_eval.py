"""Evaluation (E1-E6, M10), augmentation (G1-G3), topic tables (C4, C5, C7, C11, C12) and
the run registry (S10).

Predictions come from a nearest-centroid classifier fitted on the training rows (hash split) of the
supplied ``embeddings`` table and applied to all rows: the logits are minus the squared distances to the
class centroids over all dimensions, ``prediction`` is their arg-max and ``probability`` their softmax,
against the stored ``label``. It is a model that SQL can fit as well.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import augment as AU
from revlens.operators import classify as CL
from revlens.operators import coherence as CO
from revlens.operators import evaluate as EV
from revlens.operators import split as S
from revlens.operators import vocab as V
from revlens.plans import sqlgen as G
from revlens.plans.q_corpus import LAB_TOKS_SQL, R2_TRAIN, labelled_tokens
from revlens.plans.q_text import CLEAN_TOKS_SQL, clean_tokens
from revlens.plans.registry import query, r6
from revlens.sources.tables import read_table, reviews

DIM = 64

PRED_SQL = (
    "WITH xs AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), "
    "ce AS (SELECT label AS class, i, avg(x) AS mu FROM xs "
    "WHERE CAST(('0x' || substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 < 750 GROUP BY 1, 2), "
    "ds AS (SELECT vec_id, label, class, -sum((x - mu) * (x - mu)) AS s FROM xs JOIN ce USING (i) GROUP BY 1, 2, 3), "
    "pe AS (SELECT vec_id, label, list(s ORDER BY class) AS lg FROM ds GROUP BY 1, 2), "
    "pm AS (SELECT *, list_max(lg) AS mx FROM pe), "
    "pr AS (SELECT vec_id, label, CAST(list_position(lg, mx) - 1 AS INTEGER) AS prediction, "
    "list_transform(lg, lambda x: exp(x - mx)) AS ex FROM pm), "
    "pp AS (SELECT vec_id, label, prediction, list_transform(ex, lambda x: x / list_sum(ex)) AS probability FROM pr), "
    "c AS (SELECT label, prediction, count(*) AS n FROM pp GROUP BY ALL), "
    "cls AS (SELECT label AS class FROM c UNION SELECT prediction FROM c), "
    "tot AS (SELECT sum(n) AS t FROM c), "
    "o AS (SELECT cls.class, "
    "sum(CASE WHEN c.label = cls.class AND c.prediction = cls.class THEN n ELSE 0 END) AS tp, "
    "sum(CASE WHEN c.label <> cls.class AND c.prediction = cls.class THEN n ELSE 0 END) AS fp, "
    "sum(CASE WHEN c.label = cls.class AND c.prediction <> cls.class THEN n ELSE 0 END) AS fn "
    "FROM cls CROSS JOIN c GROUP BY cls.class), "
    "m AS (SELECT class, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p, "
    "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r, tp + fn AS support FROM o), "
    "mf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM m)"
)


def predictions(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    train = S.split_threshold(e, "vec_id").where("split = 'train'")
    scored = CL.centroid_scores(e, CL.fit_centroids(train, "label", "x", DIM), "x")
    return scored.select(
        "vec_id", "label", EV.argmax(F.col("logits")).alias("prediction"), EV.softmax(F.col("logits")).alias("probability")
    )


def _r(df, *cols):
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# E1 --------------------------------------------------------------------------------------------
@query(
    "confusion_ovr",
    PRED_SQL + " SELECT class, CAST(t - tp - fp - fn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
    "CAST(tp AS BIGINT) AS tp FROM o CROSS JOIN tot",
)
def q_confusion_ovr(spark, sf):
    return EV.confusion_ovr(predictions(spark, sf))


# E2 --------------------------------------------------------------------------------------------
@query(
    "class_report",
    PRED_SQL + ", s AS (SELECT sum(support) AS n, sum(support * r) / sum(support) AS acc, avg(p) AS mp, avg(r) AS mr, avg(f1) AS mf, "
    "sum(p * support) / sum(support) AS wp, sum(r * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf FROM mf) "
    f"SELECT CAST(class AS VARCHAR) AS row, {r6('p')} AS precision, {r6('r')} AS recall, {r6('f1')} AS f1, CAST(support AS BIGINT) AS support FROM mf "
    f"UNION ALL SELECT 'accuracy', NULL, NULL, {r6('acc')}, CAST(n AS BIGINT) FROM s "
    f"UNION ALL SELECT 'macro avg', {r6('mp')}, {r6('mr')}, {r6('mf')}, CAST(n AS BIGINT) FROM s "
    f"UNION ALL SELECT 'weighted avg', {r6('wp')}, {r6('wr')}, {r6('wf')}, CAST(n AS BIGINT) FROM s",
)
def q_class_report(spark, sf):
    return _r(EV.class_report(predictions(spark, sf)), "precision", "recall", "f1")


# E3 --------------------------------------------------------------------------------------------
@query(
    "macro_metrics",
    PRED_SQL + f" SELECT {r6('sum(support * r) / sum(support)')} AS accuracy, {r6('avg(f1)')} AS f1, "
    f"{r6('avg(p)')} AS precision, {r6('avg(r)')} AS recall FROM mf",
)
def q_macro_metrics(spark, sf):
    return _r(EV.macro_metrics(predictions(spark, sf)), "accuracy", "f1", "precision", "recall")


# E4 --------------------------------------------------------------------------------------------
@query(
    "confusion_matrix",
    PRED_SQL + " SELECT a.class AS label, b.class AS prediction, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
    "FROM cls a CROSS JOIN cls b LEFT JOIN c ON c.label = a.class AND c.prediction = b.class",
)
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(predictions(spark, sf))


# E5 --------------------------------------------------------------------------------------------
SCORES_SQL = (
    PRED_SQL + ", sc AS (SELECT label, unnest(probability) AS score, generate_subscripts(probability, 1) - 1 AS class FROM pp), "
    "h AS (SELECT class, CAST(least(floor(score * 100), 99) AS INTEGER) AS bin, sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS n_pos, "
    "sum(CASE WHEN label <> class THEN 1 ELSE 0 END) AS n_neg FROM sc GROUP BY 1, 2), "
    "cu AS (SELECT class, bin, sum(n_pos) OVER (PARTITION BY class ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp, "
    "sum(n_neg) OVER (PARTITION BY class ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp, "
    "sum(n_pos) OVER (PARTITION BY class) AS P, sum(n_neg) OVER (PARTITION BY class) AS N FROM h)"
)


def _pts(spark, sf):
    return EV.roc_pr_points(predictions(spark, sf))


@query(
    "roc_points",
    SCORES_SQL + f" SELECT CAST(class AS INTEGER) AS class, {r6('bin / 100.0')} AS threshold, "
    f"{r6('CASE WHEN P = 0 THEN 0.0 ELSE tp / P END')} AS tpr, {r6('CASE WHEN N = 0 THEN 0.0 ELSE fp / N END')} AS fpr FROM cu",
)
def q_roc_points(spark, sf):
    return _r(_pts(spark, sf).select("class", "threshold", "tpr", "fpr"), "threshold", "tpr", "fpr")


@query(
    "pr_points",
    SCORES_SQL + f" SELECT CAST(class AS INTEGER) AS class, {r6('bin / 100.0')} AS threshold, "
    f"{r6('CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END')} AS precision, {r6('CASE WHEN P = 0 THEN 0.0 ELSE tp / P END')} AS recall FROM cu",
)
def q_pr_points(spark, sf):
    p = _pts(spark, sf).select("class", "threshold", "precision", F.col("tpr").alias("recall"))
    return _r(p, "threshold", "precision", "recall")


# points at every distinct score, rounded so that both engines see the same ties
EXACT_SQL = (
    PRED_SQL + ", sc AS (SELECT label, round(unnest(probability), 6) AS score, generate_subscripts(probability, 1) - 1 AS class FROM pp), "
    "h AS (SELECT class, score, sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN label <> class THEN 1 ELSE 0 END) AS n_neg "
    "FROM sc GROUP BY 1, 2), "
    "cu AS (SELECT *, sum(n_pos) OVER (PARTITION BY class ORDER BY score DESC) AS tp, sum(n_neg) OVER (PARTITION BY class ORDER BY score DESC) AS fp, "
    "sum(n_pos) OVER (PARTITION BY class) AS P, sum(n_neg) OVER (PARTITION BY class) AS N FROM h)"
)


def _exact(spark, sf):
    rounded = F.transform("probability", lambda x: F.round(x, 6))
    return EV.exact_curve(predictions(spark, sf).withColumn("probability", rounded))


@query(
    "curve_exact",
    EXACT_SQL + f" SELECT CAST(class AS INTEGER) AS class, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
    f"{r6('CASE WHEN P = 0 THEN 0.0 ELSE tp / P END')} AS tpr, {r6('CASE WHEN N = 0 THEN 0.0 ELSE fp / N END')} AS fpr, "
    f"{r6('tp / (tp + fp)')} AS precision FROM cu",
)
def q_curve_exact(spark, sf):
    return _r(_exact(spark, sf).select("class", "threshold", "tp", "fp", "tpr", "fpr", "precision"), "tpr", "fpr", "precision")


@query(
    "curve_areas",
    EXACT_SQL + " SELECT CAST(class AS INTEGER) AS class, CAST(P AS BIGINT) AS pos, CAST(N AS BIGINT) AS neg, "
    f"{r6('CASE WHEN P > 0 AND N > 0 THEN sum(n_neg * (2 * tp - n_pos)) / (2.0 * P * N) END')} AS auc, "
    f"{r6('CASE WHEN P > 0 THEN sum(n_pos * tp / (tp + fp)) / P END')} AS average_precision FROM cu GROUP BY class, P, N",
)
def q_curve_areas(spark, sf):
    return _r(EV.curve_areas(_exact(spark, sf)), "auc", "average_precision")


@query(
    "calibration",
    SCORES_SQL + f" SELECT CAST(class AS INTEGER) AS class, CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, {r6('avg(score)')} AS mean_score, "
    f"{r6('avg(CASE WHEN label = class THEN 1.0 ELSE 0.0 END)')} AS frac_pos, count(*) AS n FROM sc GROUP BY 1, 2",
)
def q_calibration(spark, sf):
    return _r(EV.calibration(predictions(spark, sf)), "mean_score", "frac_pos")


# E6 --------------------------------------------------------------------------------------------
@query(
    "cross_entropy",
    PRED_SQL + f" SELECT {r6('avg(-ln(probability[label + 1]))')} AS loss, {r6('avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM pp",
)
def q_cross_entropy(spark, sf):
    return _r(EV.cross_entropy(predictions(spark, sf)), "loss", "accuracy")


# M10 -------------------------------------------------------------------------------------------
@query(
    "one_hot",
    f"WITH {G.REVIEWS_CTE} SELECT doc_id, array_to_string(list_transform(range(3), lambda k: CASE WHEN k = sentiment THEN 1 ELSE 0 END), ',') AS one_hot "
    "FROM reviews WHERE sentiment IS NOT NULL",
)
def q_one_hot(spark, sf):
    r = reviews(spark, sf).where(F.col("sentiment").isNotNull())
    return r.select("doc_id", F.array_join(EV.one_hot(F.col("sentiment"), 3), ",").alias("one_hot"))


# C5 --------------------------------------------------------------------------------------------
@query(
    "cluster_sizes",
    PRED_SQL + ", k AS (SELECT prediction AS cluster, CAST(count(*) AS BIGINT) AS n FROM pp GROUP BY 1) "
    "SELECT cluster, n, CAST(row_number() OVER (ORDER BY n DESC, cluster) AS INTEGER) AS rank FROM k",
)
def q_cluster_sizes(spark, sf):
    a = predictions(spark, sf).select(F.col("prediction").alias("cluster"))
    return CO.ranked_clusters(a).withColumn("rank", F.col("rank").cast("int"))


# G1 / G2 / G3 ----------------------------------------------------------------------------------
AUG_SQL = (
    CLEAN_TOKS_SQL
    + f", trn AS (SELECT ct.doc_id, r.sentiment, ct.toks FROM ct JOIN reviews r ON r.doc_id = ct.doc_id WHERE r.sentiment IS NOT NULL AND {R2_TRAIN.replace('doc_id', 'ct.doc_id')}), "
    "gc AS (SELECT sentiment, CAST(count(*) AS BIGINT) AS n FROM trn GROUP BY 1), "
    "gk AS (SELECT sentiment, n, CAST(floor((max(n) OVER () - n) / n) AS INTEGER) AS k FROM gc), "
    "sdf AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(toks) AS term FROM ct) GROUP BY term), "
    "syn AS (SELECT term AS word, [reverse(term), term || term] AS syns FROM sdf WHERE df >= 2), "
    "tk AS (SELECT t.doc_id, t.sentiment, gk.k, unnest(t.toks) AS tok, generate_subscripts(t.toks, 1) - 1 AS pos FROM trn t JOIN gk ON gk.sentiment = t.sentiment WHERE gk.k >= 1), "
    "cp AS (SELECT tk.*, syn.syns, unnest(range(1, tk.k + 1)) AS copy FROM tk LEFT JOIN syn ON syn.word = tk.tok), "
    "hv AS (SELECT *, CAST(('0x' || substr(md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR), CAST(pos AS VARCHAR), 'r')), 1, 8)) AS BIGINT) AS ur, "
    "CAST(('0x' || substr(md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR), CAST(pos AS VARCHAR), 's')), 1, 8)) AS BIGINT) AS us FROM cp), "
    "vr AS (SELECT doc_id, copy, sentiment, pos, CASE WHEN syns IS NOT NULL AND len(syns) > 0 AND ur % 1000 < 300 THEN syns[us % len(syns) + 1] ELSE tok END AS w FROM hv), "
    "aug AS (SELECT doc_id, CAST(copy AS INTEGER) AS copy, sentiment, string_agg(w, ' ' ORDER BY pos) AS text FROM vr GROUP BY doc_id, copy, sentiment "
    "UNION ALL SELECT t.doc_id, CAST(c.copy AS INTEGER), t.sentiment, '' FROM trn t JOIN gk ON gk.sentiment = t.sentiment, "
    "unnest(range(1, gk.k + 1)) AS c(copy) WHERE len(t.toks) = 0 AND gk.k >= 1 "
    "UNION ALL SELECT doc_id, 0, sentiment, array_to_string(toks, ' ') FROM trn)"
)


def _aug_inputs(spark, sf):
    toks = labelled_tokens(spark, sf)
    train = S.split_threshold(toks).where(F.col("split") == "train").drop("split")
    dfs = V.document_frequency(clean_tokens(spark, sf), "doc_id", "toks").where(F.col("df") >= 2)
    syn = dfs.select(F.col("term").alias("word"), F.array(F.reverse("term"), F.concat("term", "term")).alias("synonyms"))
    return train, syn


@query("augment_factor", AUG_SQL + " SELECT sentiment, n, k FROM gk")
def q_augment_factor(spark, sf):
    train, _ = _aug_inputs(spark, sf)
    return AU.copies_per_sample(train, "sentiment")


@query("synonym_augment", AUG_SQL + " SELECT doc_id, copy, sentiment, text FROM aug")
def q_synonym_augment(spark, sf):
    train, syn = _aug_inputs(spark, sf)
    out = AU.balance_by_augmentation(train, "doc_id", "toks", "sentiment", syn)
    return out.select("doc_id", F.col("copy").cast("int").alias("copy"), "sentiment", T.join_tokens(F.col("toks")).alias("text"))


@query("balanced_train", AUG_SQL + " SELECT sentiment, CAST(count(*) AS BIGINT) AS n FROM aug GROUP BY 1")
def q_balanced_train(spark, sf):
    train, syn = _aug_inputs(spark, sf)
    out = AU.balance_by_augmentation(train, "doc_id", "toks", "sentiment", syn)
    return out.groupBy("sentiment").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# C4 / C7 / C11 / C12 ---------------------------------------------------------------------------
TOPIC_SQL = (
    LAB_TOKS_SQL
    + ", tw AS (SELECT sentiment, term, CAST(sum(tf) AS BIGINT) AS weight FROM bow GROUP BY 1, 2), "
    "top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sentiment ORDER BY weight DESC, term) AS INTEGER) AS rank FROM tw) WHERE rank <= 20), "
    "dt AS (SELECT DISTINCT sentiment, doc_id, unnest(toks) AS term FROM lt)"
)


def sql_umass(topics: str, corpus: str, topic: str, out: str) -> str:
    """UMass per topic by self-join on documents (oracle only). ``topics`` has (sentiment,
    {topic}, term, rank); ``corpus`` (sentiment, doc_id, term); n_docs from ``nd``."""
    k = f"a.sentiment = b.sentiment AND a.{topic} = b.{topic}"
    return (
        f"{out}_o AS (SELECT t.sentiment, t.{topic}, t.rank, d.doc_id FROM {topics} t JOIN {corpus} d ON d.sentiment = t.sentiment AND d.term = t.term), "
        f"{out}_dj AS (SELECT sentiment, {topic}, rank, count(*) AS d FROM {out}_o GROUP BY ALL), "
        f"{out}_dij AS (SELECT a.sentiment, a.{topic}, a.rank AS ri, b.rank AS rj, count(*) AS d FROM {out}_o a JOIN {out}_o b "
        f"ON a.doc_id = b.doc_id AND {k} AND a.rank > b.rank GROUP BY ALL), "
        f"{out}_p AS (SELECT a.sentiment, a.{topic}, a.rank AS ri, b.rank AS rj FROM {topics} a JOIN {topics} b ON {k} AND a.rank > b.rank), "
        f"{out}_v AS (SELECT p.sentiment, p.{topic}, CASE WHEN coalesce(dj.d, 0) = 0 THEN 0.0 "
        f"ELSE ln((coalesce(dij.d, 0) / nd.n_docs + 1e-12) / (dj.d / nd.n_docs)) END AS v FROM {out}_p p "
        f"JOIN nd ON nd.sentiment = p.sentiment "
        f"LEFT JOIN {out}_dj dj ON dj.sentiment = p.sentiment AND dj.{topic} = p.{topic} AND dj.rank = p.rj "
        f"LEFT JOIN {out}_dij dij ON dij.sentiment = p.sentiment AND dij.{topic} = p.{topic} AND dij.ri = p.ri AND dij.rj = p.rj), "
        f"{out} AS (SELECT sentiment, {topic}, avg(v) AS coherence FROM {out}_v GROUP BY ALL)"
    )


def _topic_inputs(spark, sf):
    """Class corpora, vocabularies and class-as-topic term weights. The vocabulary and the
    weights are small (classes x vocabulary) and read several times by each topic query, so
    they are persisted (MEMORY_AND_DISK) instead of being recomputed per branch."""
    from pyspark import StorageLevel

    lt = labelled_tokens(spark, sf)
    voc = V.filter_extremes(lt, "doc_id", "toks", ["sentiment"]).persist(StorageLevel.MEMORY_AND_DISK)
    bow = V.bag_of_words(lt, "doc_id", "toks", voc, ["sentiment"])
    weights = bow.groupBy("sentiment", "term").agg(F.sum("tf").cast("bigint").alias("weight")).persist(StorageLevel.MEMORY_AND_DISK)
    dt = lt.select("sentiment", "doc_id", F.explode(F.array_distinct("toks")).alias("term"))
    return lt, voc, weights, dt


@query("topic_top_words", TOPIC_SQL + " SELECT sentiment, term, weight, rank FROM top")
def q_topic_top_words(spark, sf):
    _, _, weights, _ = _topic_inputs(spark, sf)
    return CO.top_terms(weights, ["sentiment"], 20).withColumn("rank", F.col("rank").cast("int"))


@query(
    "umass",
    TOPIC_SQL + ", top1 AS (SELECT sentiment, 0 AS topic, term, rank FROM top), " + sql_umass("top1", "dt", "topic", "um")
    + f" SELECT sentiment, {r6('coherence')} AS coherence FROM um",
)
def q_umass(spark, sf):
    lt, _, weights, dt = _topic_inputs(spark, sf)
    top = CO.top_terms(weights, ["sentiment"], 20).withColumn("topic", F.lit(0))
    out = CO.umass(top, dt, V.doc_counts(lt, ["sentiment"]), ["sentiment"], ["topic"])
    return out.select("sentiment", F.round("coherence", 6).alias("coherence"))


KS = (2, 3, 4, 5)


@query(
    "score_by_k",
    TOPIC_SQL
    + ", rt AS (SELECT sentiment, k AS num_topics, term_id % k AS topic, term, CAST(floor(term_id / k) + 1 AS INTEGER) AS rank "
    f"FROM voc CROSS JOIN (SELECT unnest({list(KS)}) AS k) WHERE floor(term_id / k) + 1 <= 20), "
    "rtk AS (SELECT sentiment, num_topics * 100 + topic AS kt, term, rank FROM rt), "
    + sql_umass("rtk", "dt", "kt", "uk")
    + ", per AS (SELECT sentiment, kt // 100 AS num_topics, avg(coherence) AS c FROM uk GROUP BY ALL) "
    f"SELECT CAST(num_topics AS INTEGER) AS num_topics, {r6('avg(c)')} AS score FROM per GROUP BY 1",
)
def q_score_by_k(spark, sf):
    lt, voc, _, dt = _topic_inputs(spark, sf)
    cand = CO.residue_topics(voc, ["sentiment"], KS)
    per_topic = CO.umass(cand, dt, V.doc_counts(lt, ["sentiment"]), ["sentiment"], ["num_topics", "topic"])
    per_model = CO.model_coherence(per_topic, ["sentiment", "num_topics"])
    out = per_model.groupBy("num_topics").agg(F.avg("coherence").alias("score"))
    return out.select(F.col("num_topics").cast("int"), F.round("score", 6).alias("score"))


@query(
    "term_relevance",
    TOPIC_SQL
    + ", tot AS (SELECT sum(weight) AS t FROM tw), mg AS (SELECT term, sum(weight) AS w FROM tw GROUP BY term), "
    "rel AS (SELECT tw.sentiment, tw.term, tw.weight / sum(tw.weight) OVER (PARTITION BY tw.sentiment) AS pwt, mg.w / tot.t AS pw "
    "FROM tw JOIN mg ON mg.term = tw.term CROSS JOIN tot), "
    "rv AS (SELECT sentiment, term, 0.6 * ln(pwt) + 0.4 * ln(pwt / pw) AS relevance FROM rel), "
    "rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY sentiment ORDER BY relevance DESC, term) AS INTEGER) AS rank FROM rv) "
    f"SELECT sentiment, term, rank, {r6('relevance')} AS relevance FROM rk WHERE rank <= 30",
)
def q_term_relevance(spark, sf):
    _, _, weights, _ = _topic_inputs(spark, sf)
    out = CO.term_relevance(weights, ["sentiment"], 0.6, 30)
    return out.select("sentiment", "term", F.col("rank").cast("int"), F.round("relevance", 6).alias("relevance"))


# S10 -------------------------------------------------------------------------------------------
@query(
    "latest_run",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n_runs, arg_max(event_id, (ts, event_id)) AS latest_id FROM events GROUP BY event_type",
)
def q_latest_run(spark, sf):
    from revlens.sources.registry import latest_runs

    ev = read_table(spark, sf, "events")
    return latest_runs(ev, "event_type", "ts", "event_id")
