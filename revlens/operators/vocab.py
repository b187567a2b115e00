"""Vocabulary, bag of words and TF-IDF as long tables.

The long form ``(group, doc_id, term, tf)`` is the shuffle-friendly representation: every
statistic is a ``groupBy`` with map-side combining, and per-document normalisation is a
window partitioned by document (bounded by the document's length).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.arrays import explode_rows
from revlens.operators.split import ordered_rank


def rank_terms(dfs: DataFrame, group_cols=(), prefix: int = 2) -> DataFrame:
    """0-based ``term_id`` by (df desc, term) per group. Buckets of (df, term prefix) keep the
    per-task sort small even for a hot group with a very large vocabulary."""
    ranked = ordered_rank(
        dfs, [F.desc("df"), F.asc("term")], [-F.col("df"), F.substring("term", 1, prefix)], tuple(group_cols), "__r"
    )
    return ranked.withColumn("term_id", (F.col("__r") - 1).cast("int")).drop("__r")


def doc_terms(df: DataFrame, key: str, tokens_col: str, group_cols=()) -> DataFrame:
    """(group..., key, term, tf): term counts per document."""
    g = list(group_cols)
    return (
        explode_rows(df, [*g, key], tokens_col, "term")
        .groupBy(*g, key, "term")
        .agg(F.count(F.lit(1)).cast("bigint").alias("tf"))
    )


def doc_counts(df: DataFrame, group_cols=()) -> DataFrame:
    """Documents per group (empty documents included)."""
    g = list(group_cols)
    return df.groupBy(*g).agg(F.count(F.lit(1)).alias("n_docs"))


def document_frequency(df: DataFrame, key: str, tokens_col: str, group_cols=()) -> DataFrame:
    g = list(group_cols)
    return (
        explode_rows(df, g, F.array_distinct(tokens_col), "term")
        .groupBy(*g, "term")
        .agg(F.count(F.lit(1)).cast("bigint").alias("df"))
    )


def filter_extremes(
    df: DataFrame, key: str, tokens_col: str, group_cols=(), no_below: int = 20, no_above: float = 0.5, keep_n: int | None = 100000
) -> DataFrame:
    """B1: keep ``no_below <= df <= int(no_above * n_docs)``, then the ``keep_n`` most frequent
    (ties by term). Returns (group..., term, df, term_id) with 0-based ids in that order."""
    g = list(group_cols)
    dfs = document_frequency(df, key, tokens_col, g)
    if g:
        kept = dfs.join(F.broadcast(doc_counts(df, g)), g)  # one row per group
    else:
        kept = dfs.withColumn("n_docs", df.agg(F.count(F.lit(1))).scalar())  # scalar subquery
    kept = kept.where((F.col("df") >= no_below) & (F.col("df") <= F.floor(F.col("n_docs") * F.lit(no_above))))
    ranked = rank_terms(kept, g)
    if keep_n is not None:
        ranked = ranked.where(F.col("term_id") < keep_n)
    return ranked.select(*g, "term", "df", "term_id")


def bag_of_words(df: DataFrame, key: str, tokens_col: str, vocab: DataFrame, group_cols=()) -> DataFrame:
    """B2: (group..., key, term, term_id, tf) for in-vocabulary terms only."""
    g = list(group_cols)
    return doc_terms(df, key, tokens_col, g).join(vocab.select(*g, "term", "term_id"), [*g, "term"])


def _l2_normalise(w: DataFrame, key_cols: list, weight: str, eps: float) -> DataFrame:
    norm = F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(Window.partitionBy(*key_cols)))
    out = w.withColumn(weight, F.col(weight) / norm)
    return out.where(F.abs(F.col(weight)) > eps)


def tfidf_topic(bow: DataFrame, n_docs: DataFrame, key: str, group_cols=(), eps: float = 1e-12) -> DataFrame:
    """``tf * log2(N / df)`` over a BoW table, L2-normalised per document, near-zero
    weights dropped. ``n_docs`` has (group..., n_docs)."""
    g = list(group_cols)
    dfs = bow.groupBy(*g, "term").agg(F.count(F.lit(1)).alias("df"))
    if not g:
        dfs = dfs.withColumn("n_docs", n_docs.select("n_docs").scalar())
    else:
        dfs = dfs.join(F.broadcast(n_docs), g)  # one row per group
    idf = dfs.select(*g, "term", (F.log2(F.col("n_docs") / F.col("df"))).alias("idf"))
    w = bow.join(idf, [*g, "term"]).where(F.col("idf") != 0).withColumn("weight", F.col("tf") * F.col("idf"))
    return _l2_normalise(w, [*g, key], "weight", eps).drop("idf")


def smooth_idf(df: DataFrame, key: str, tokens_col: str, n_docs=None) -> DataFrame:
    """(term, idf) with ``idf = ln((1 + N) / (1 + df)) + 1`` (smoothed IDF). N defaults to the
    number of rows of ``df`` as a scalar subquery."""
    dfs = document_frequency(df, key, tokens_col)
    n = df.agg(F.count(F.lit(1))).scalar() if n_docs is None else F.lit(n_docs)
    return dfs.select("term", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))


def tfidf_classifier(docs: DataFrame, key: str, tokens_col: str, idf: DataFrame) -> DataFrame:
    """``tf * idf`` with the IDF table fitted on the training documents, L2-normalised."""
    w = doc_terms(docs, key, tokens_col).join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    return _l2_normalise(w, [key], "weight", 0.0).select(key, "term", "tf", "weight")
