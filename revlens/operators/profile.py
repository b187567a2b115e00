"""Profiling and label operators.

All aggregates are plain ``groupBy``/``agg`` with map-side partial aggregation; windows
only run over already-aggregated, bounded results (one row per class or rating).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.arrays import explode_rows
from revlens.functions.wordlists import RATING_TO_SENTIMENT


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


# P3 / P4 / P5 ----------------------------------------------------------------------------
def rating_to_sentiment(rating: Column) -> Column:
    return F.try_element_at(_map_literal(RATING_TO_SENTIMENT), rating)


def recode_labels(df: DataFrame, mapping: dict, label_col: str, new_label_col: str = "labels") -> DataFrame:
    """Map ``label_col`` through ``mapping``; keys not in the map become null."""
    return df.withColumn(new_label_col, F.try_element_at(_map_literal(mapping), F.col(label_col)))


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with any null (in ``subset`` if given)."""
    return df.na.drop("any", subset=subset)


# P9 -----------------------------------------------------------------------------------------
def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null count, null count (``DataFrame.info``)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    stack = "stack({n}, {body}) as (column_name, dtype, non_null)".format(
        n=len(cols),
        body=", ".join(f"'{c}', '{dtypes[c]}', c{i}" for i, c in enumerate(cols)),
    )
    return wide.selectExpr("__rows", stack).select(
        "column_name", "dtype", F.col("non_null").cast("bigint").alias("non_null"),
        (F.col("__rows") - F.col("non_null")).cast("bigint").alias("nulls"),
    )


# P10 ----------------------------------------------------------------------------------------
def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row exactly: sum over groups of (size - 1); groups go by a 256-bit
    digest, so no text is shuffled."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    groups = df.groupBy(row.alias("digest")).count()
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


# A1 / A7 ------------------------------------------------------------------------------------
def describe_numeric(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max (pandas ``describe``).

    ``percentile`` is exact; its buffer holds one entry per distinct value, which is bounded
    for ratings and document lengths.
    """
    c = F.col(col)
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.agg(
        F.count(c).cast("bigint").alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"),
        q.alias("q"),
        F.max(c).cast("double").alias("max"),
    ).select(
        "n", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max",
    )


# A2 -----------------------------------------------------------------------------------------
def value_distribution(df: DataFrame, col: str, count_col: str = "doc_id", digits: int = 2) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(count_col).cast("bigint").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over the bounded aggregate only
    return counts.withColumn("proportion", F.round(F.col("n") / total, digits)).orderBy(F.desc("n"), col)


# A3 / A4 / A10 ----------------------------------------------------------------------------------
def value_counts(df: DataFrame, *cols: str, count_col: str | None = None) -> DataFrame:
    agg = F.count(count_col) if count_col else F.count(F.lit(1))
    return df.groupBy(*cols).agg(agg.cast("bigint").alias("n")).orderBy(F.desc("n"), *cols)


# A5 -----------------------------------------------------------------------------------------
def sparse_categories(df: DataFrame, category: str, label: str, min_samples: int = 10, n_classes: int = 3) -> DataFrame:
    g = df.groupBy(category).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_distinct(label).cast("bigint").alias("n_labels"),
    )
    return g.where((F.col("n") < min_samples) | (F.col("n_labels") < n_classes))


# A6 -----------------------------------------------------------------------------------------
def mean_by(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


# A9 / O2 ------------------------------------------------------------------------------------
def top_k_per_group(df: DataFrame, group: str, order: list, k: int, rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per group. Spark plans a partial WindowGroupLimit before the
    exchange, so each map task forwards at most k rows per group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top_words(tokens_df: DataFrame, group: str, tokens_col: str, k: int = 20) -> DataFrame:
    """Top-k words per group by occurrence count (ties broken by word)."""
    words = explode_rows(tokens_df, [group], tokens_col, "word")
    counts = words.groupBy(group, "word").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return top_k_per_group(counts, group, [F.desc("n"), F.asc("word")], k)


# A11 ----------------------------------------------------------------------------------------
def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias("majority"),
        (F.max("n") / F.sum("n")).alias("accuracy"),
    )
