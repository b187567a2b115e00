"""Readers for the supplied parquet tables and the review view built from them.

The supplied ``documents`` table plays the review corpus; ``labels`` carries the
sentiment signal (toxic -> negative, low quality -> neutral, else positive) and
``rating`` is derived from the key for the rating-only operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give CPU-heavy text work at least one partition per core.

    A large input already has one split per file block and is returned unchanged; a small
    input stored as a single row group would otherwise run in one task. With ``key`` the
    rows are hash-partitioned on it so later joins and groupings on the key reuse it.
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:
        return df
    return df.repartition(par, key) if key else df.repartition(par)


def sentiment_from_flags(quality: Column, toxic: Column) -> Column:
    """0 negative, 1 neutral, 2 positive."""
    return (
        F.when(toxic == 1, F.lit(0))
        .when(quality == 0, F.lit(1))
        .when(quality.isNotNull() & toxic.isNotNull(), F.lit(2))
        .cast("int")
    )


def rating_from_key(key: Column) -> Column:
    return (F.lit(1) + F.pmod(key, F.lit(5))).cast("int")


def unlabelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review table without its label: no join, so texts are not shuffled.

    Columns: doc_id, text, category, brand, n_chars, rating.
    """
    docs = spread(read_table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "text", F.col("lang").alias("category"), F.col("source").alias("brand"), "n_chars"
    )
    return docs.withColumn("rating", rating_from_key(F.col("doc_id")))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels as the review table, for what reads the label.

    Columns: doc_id, text, category, brand, n_chars, rating, sentiment (null when unlabelled).
    The join is an equi-join on doc_id; AQE broadcasts ``labels`` only when its runtime size
    is under the broadcast threshold, otherwise it is a shuffle join.
    """
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", sentiment_from_flags(F.col("quality"), F.col("toxic")).alias("sentiment")
    )
    return unlabelled_reviews(spark, sf_dir).join(labels, "doc_id", "left")


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join of text and label."""
    return reviews(spark, sf_dir).where(F.col("sentiment").isNotNull())
