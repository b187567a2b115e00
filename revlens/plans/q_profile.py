"""Profiling, label, join and split queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.functions.wordlists import LABEL_TO_POLARITY, POLARITY_TO_LABEL, RATING_TO_LABEL, extended_stop_words
from revlens.operators import profile as P
from revlens.operators import split as S
from revlens.plans import sqlgen as G
from revlens.plans.registry import query
from revlens.sources.tables import labelled_reviews, read_table, reviews, unlabelled_reviews

W = f"WITH {G.REVIEWS_CTE}"
LAB = f"WITH {G.REVIEWS_CTE}, lab AS (SELECT * FROM reviews WHERE sentiment IS NOT NULL)"
HASH = "md5('42:' || CAST(doc_id AS VARCHAR))"


def _round(df, *cols):
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# P9 --------------------------------------------------------------------------------------------
_NP_COLS = [("doc_id", "bigint"), ("text", "string"), ("category", "string"), ("brand", "string"),
            ("n_chars", "bigint"), ("sentiment", "int"), ("rating", "int")]


@query(
    "null_profile",
    W + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM reviews"
        for c, t in _NP_COLS
    ),
)
def q_null_profile(spark, sf):
    return P.null_profile(reviews(spark, sf))


# P10 -------------------------------------------------------------------------------------------
@query(
    "duplicate_rows",
    "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates FROM "
    "(SELECT count(*) AS c FROM documents GROUP BY text, lang, source, n_chars)",
)
def q_duplicate_rows(spark, sf):
    return P.duplicate_rows(read_table(spark, sf, "documents").drop("doc_id"))


# A1 / A7 ---------------------------------------------------------------------------------------
def _describe_sql(src: str, col: str) -> str:
    return (
        f"SELECT CAST(count({col}) AS BIGINT) AS n, round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS std, "
        f"round(CAST(min({col}) AS DOUBLE), 6) AS min, round(quantile_cont({col}, 0.25), 6) AS p25, "
        f"round(quantile_cont({col}, 0.5), 6) AS p50, round(quantile_cont({col}, 0.75), 6) AS p75, "
        f"round(CAST(max({col}) AS DOUBLE), 6) AS max FROM {src}"
    )


_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


@query("rating_stats", W + " " + _describe_sql("reviews", "rating"))
def q_rating_stats(spark, sf):
    return _round(P.describe_numeric(unlabelled_reviews(spark, sf), "rating"), *_STATS)


@query(
    "length_stats",
    W + f", lens AS (SELECT len({G.tokenize('text')}) AS doc_len FROM reviews) " + _describe_sql("lens", "doc_len"),
)
def q_length_stats(spark, sf):
    df = unlabelled_reviews(spark, sf).select(T.doc_length(T.tokenize(F.col("text"))).alias("doc_len"))
    return _round(P.describe_numeric(df, "doc_len"), *_STATS)


# A2 --------------------------------------------------------------------------------------------
@query(
    "rating_distribution",
    W + ", c AS (SELECT rating, CAST(count(doc_id) AS BIGINT) AS n FROM reviews GROUP BY rating) "
    "SELECT rating, n, round(n / sum(n) OVER (), 2) AS proportion FROM c",
)
def q_rating_distribution(spark, sf):
    return P.value_distribution(unlabelled_reviews(spark, sf), "rating")


# A3 --------------------------------------------------------------------------------------------
_NAMES_SQL = "(['Negative', 'Neutral', 'Positive'])[sentiment + 1]"


def _sentiment_name(c):
    return F.element_at(F.array(F.lit("Negative"), F.lit("Neutral"), F.lit("Positive")), c + 1)


@query(
    "sentiment_counts",
    LAB + f" SELECT {_NAMES_SQL} AS sentiment_name, CAST(count(*) AS BIGINT) AS n FROM lab GROUP BY 1",
)
def q_sentiment_counts(spark, sf):
    df = labelled_reviews(spark, sf).withColumn("sentiment_name", _sentiment_name(F.col("sentiment")))
    return P.value_counts(df, "sentiment_name")


# A4 --------------------------------------------------------------------------------------------
@query(
    "category_sentiment",
    LAB + " SELECT category, sentiment, CAST(count(doc_id) AS BIGINT) AS n FROM lab GROUP BY 1, 2",
)
def q_category_sentiment(spark, sf):
    return P.value_counts(labelled_reviews(spark, sf), "category", "sentiment", count_col="doc_id")


# A5 --------------------------------------------------------------------------------------------
@query(
    "sparse_categories",
    LAB + " SELECT brand, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT sentiment) AS BIGINT) AS n_labels "
    "FROM lab GROUP BY brand HAVING count(*) < 10 OR count(DISTINCT sentiment) < 3",
)
def q_sparse_categories(spark, sf):
    return P.sparse_categories(labelled_reviews(spark, sf), "brand", "sentiment")


# A6 --------------------------------------------------------------------------------------------
@query(
    "length_by_sentiment",
    LAB + f" SELECT sentiment, round(avg(len({G.tokenize('text')})), 6) AS avg_len FROM lab GROUP BY sentiment",
)
def q_length_by_sentiment(spark, sf):
    df = P.mean_by(labelled_reviews(spark, sf), "sentiment", T.doc_length(T.tokenize(F.col("text"))), "avg_len")
    return _round(df, "avg_len")


# A9 (flagship) ---------------------------------------------------------------------------------
TOP_WORDS_SQL = (
    LAB
    + f", t AS (SELECT sentiment, unnest({G.quick_tokens('text')}) AS word FROM lab), "
    "c AS (SELECT sentiment, word, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1, 2), "
    "k AS (SELECT *, CAST(row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, word) AS INTEGER) AS rank FROM c) "
    "SELECT sentiment, word, n, rank FROM k WHERE rank <= 20"
)


def top_words_plan(docs):
    toks = docs.select("sentiment", T.quick_tokens(F.col("text"), extended_stop_words()).alias("tokens"))
    return P.top_words(toks, "sentiment", "tokens", 20)


@query("top_words", TOP_WORDS_SQL)
def q_top_words(spark, sf):
    return top_words_plan(labelled_reviews(spark, sf))


# A11 -------------------------------------------------------------------------------------------
@query(
    "majority_baseline",
    LAB + ", c AS (SELECT sentiment, count(*) AS n FROM lab GROUP BY 1) "
    "SELECT CAST(arg_max(sentiment, n * 10 - sentiment) AS INTEGER) AS majority, round(max(n) / sum(n), 6) AS accuracy FROM c",
)
def q_majority_baseline(spark, sf):
    return _round(P.majority_baseline(labelled_reviews(spark, sf), "sentiment"), "accuracy")


# P4 / P5 ---------------------------------------------------------------------------------------
def _case_sql(col: str, mapping: dict) -> str:
    return "CAST(CASE " + col + " " + " ".join(f"WHEN {k} THEN {v}" for k, v in mapping.items()) + " END AS INTEGER)"


@query("label_map", W + f" SELECT doc_id, rating, {_case_sql('rating', RATING_TO_LABEL)} AS labels FROM reviews")
def q_label_map(spark, sf):
    return P.recode_labels(unlabelled_reviews(spark, sf).select("doc_id", "rating"), RATING_TO_LABEL, "rating", "labels")


@query(
    "label_recode",
    LAB + f", p AS (SELECT doc_id, sentiment, {_case_sql('sentiment', LABEL_TO_POLARITY)} AS polarity FROM lab) "
    f"SELECT doc_id, sentiment, polarity, {_case_sql('polarity', POLARITY_TO_LABEL)} AS back FROM p",
)
def q_label_recode(spark, sf):
    df = labelled_reviews(spark, sf).select("doc_id", "sentiment")
    df = P.recode_labels(df, LABEL_TO_POLARITY, "sentiment", "polarity")
    return P.recode_labels(df, POLARITY_TO_LABEL, "polarity", "back")


# P7 / P8 ---------------------------------------------------------------------------------------
def clean_sql(expr: str) -> str:
    """Default cleaning pipeline (T12, string output) in DuckDB SQL."""
    x = f"translate({expr}, '’‘', '''''')"
    x = G.fold_accents(x)
    x = G.expand_contractions(x)
    x = G.apostrophe_spacing(x)
    x = G.strip_special(x)
    x = f"lower({x})"
    return f"nullif({G.join_tokens(G.stop_filter(G.tokenize(x)))}, '')"


@query(
    "null_drop",
    W + f", c AS (SELECT doc_id, sentiment, {clean_sql('text')} AS clean FROM reviews) "
    "SELECT doc_id, sentiment, clean FROM c WHERE clean IS NOT NULL AND sentiment IS NOT NULL",
)
def q_null_drop(spark, sf):
    # only labelled texts are cleaned, once: a filter on a projected column would compute it twice
    clean = F.array(T.clean_text(F.col("text"), T.CleanOptions(tokenize=False)))
    df = labelled_reviews(spark, sf).select("doc_id", "sentiment", F.explode_outer(clean).alias("clean"))
    return P.drop_incomplete(df)


# J1 --------------------------------------------------------------------------------------------
@query(
    "label_join",
    "SELECT d.doc_id, CAST(CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 0 THEN 1 ELSE 2 END AS INTEGER) AS sentiment, "
    "d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def q_label_join(spark, sf):
    return labelled_reviews(spark, sf).select("doc_id", "sentiment", "n_chars")


# R1 --------------------------------------------------------------------------------------------
@query(
    "split_exact",
    W + f", r AS (SELECT doc_id, row_number() OVER (ORDER BY {HASH}, doc_id) AS rank, count(*) OVER () AS n FROM reviews) "
    "SELECT doc_id, rank, CASE WHEN rank <= floor(floor(n * 0.9) * 0.1) THEN 'validation' "
    "WHEN rank <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS split FROM r",
)
def q_split_exact(spark, sf):
    return S.split_exact(unlabelled_reviews(spark, sf).select("doc_id"), rank_col="rank").select("doc_id", "rank", "split")


# R2 --------------------------------------------------------------------------------------------
R2_SQL = f"CASE WHEN CAST(('0x' || substr({HASH}, 1, 8)) AS BIGINT) % 1000 < 750 THEN 'train' ELSE 'test' END"


@query("split_threshold", W + f" SELECT doc_id, {R2_SQL} AS split FROM reviews")
def q_split_threshold(spark, sf):
    return S.split_threshold(unlabelled_reviews(spark, sf).select("doc_id"))


# R3 --------------------------------------------------------------------------------------------
@query(
    "validation_carve",
    W + f", s AS (SELECT doc_id, {R2_SQL} AS split, count(*) OVER () AS n FROM reviews), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {HASH}, doc_id) AS rk FROM s) "
    "SELECT doc_id, CASE WHEN split = 'train' AND rk <= floor(n * 0.2) THEN 'validation' ELSE split END AS split FROM r",
)
def q_validation_carve(spark, sf):
    return S.carve_validation(S.split_threshold(unlabelled_reviews(spark, sf).select("doc_id"))).select("doc_id", "split")


# R5 --------------------------------------------------------------------------------------------
@query(
    "fold_assign",
    LAB + f" SELECT doc_id, sentiment, CAST((row_number() OVER (PARTITION BY sentiment ORDER BY {HASH}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM lab",
)
def q_fold_assign(spark, sf):
    return S.assign_folds(labelled_reviews(spark, sf).select("doc_id", "sentiment"), "sentiment").select("doc_id", "sentiment", "fold")


# R6 --------------------------------------------------------------------------------------------
@query(
    "class_weights",
    LAB + ", c AS (SELECT sentiment, CAST(count(*) AS BIGINT) AS n FROM lab GROUP BY 1) "
    "SELECT sentiment, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c",
)
def q_class_weights(spark, sf):
    return _round(S.class_weights(labelled_reviews(spark, sf), "sentiment"), "weight")


# O3 --------------------------------------------------------------------------------------------
@query(
    "clip_corpus",
    W + f", r AS (SELECT doc_id, row_number() OVER (ORDER BY {HASH}, doc_id) AS rk, count(*) OVER () AS n FROM reviews) "
    "SELECT doc_id FROM r WHERE rk <= floor(n * 0.5)",
)
def q_clip_corpus(spark, sf):
    return S.clip_corpus(unlabelled_reviews(spark, sf).select("doc_id"), 0.5)


# P3 --------------------------------------------------------------------------------------------
@query(
    "rating_sentiment",
    W + " SELECT doc_id, rating, CASE WHEN rating IN (1, 2) THEN 'Negative' WHEN rating = 3 THEN 'Neutral' "
    "WHEN rating IN (4, 5) THEN 'Positive' END AS sentiment_name FROM reviews",
)
def q_rating_sentiment(spark, sf):
    r = unlabelled_reviews(spark, sf)
    return r.select("doc_id", "rating", P.rating_to_sentiment(F.col("rating")).alias("sentiment_name"))


# A10 -------------------------------------------------------------------------------------------
@query(
    "split_sizes",
    W + f", r AS (SELECT doc_id, row_number() OVER (ORDER BY {HASH}, doc_id) AS rank, count(*) OVER () AS n FROM reviews), "
    "s AS (SELECT CASE WHEN rank <= floor(floor(n * 0.9) * 0.1) THEN 'validation' WHEN rank <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS split FROM r) "
    "SELECT split, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY split",
)
def q_split_sizes(spark, sf):
    return P.value_counts(S.split_exact(unlabelled_reviews(spark, sf).select("doc_id")), "split")
