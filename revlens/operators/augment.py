"""Class balancing by synonym augmentation.

Copies are generated with ``explode(sequence(1, k))`` per row and every random choice is a
seeded hash of (seed, key, copy, position), so a rerun (or a retried task) produces the same
rows. The synonym table is joined once per token occurrence; copies are made in the row after the regrouping
shuffle, so what is shuffled does not grow with their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.arrays import explode_rows


def copies_per_sample(df: DataFrame, label: str) -> DataFrame:
    """G1: (label, n, k) with ``k = floor((target - n) / n)`` and target = the largest class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    target = F.max("n").over(Window.partitionBy())  # over one row per class
    return counts.withColumn("k", F.floor((target - F.col("n")) / F.col("n")).cast("int"))


def _u(*parts: Column) -> Column:
    """Uniform integer in [0, 2**32) from a seeded md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("bigint")


def synonym_augment(
    df: DataFrame, key: str, tokens_col: str, label: str, synonyms: DataFrame, k_col: str = "k", p: float = 0.3, seed: int = 42
) -> DataFrame:
    """Each row kept (copy 0) plus ``k`` variants; in a variant each token that has
    synonyms is replaced with probability ``p`` by one of them (both choices hashed).

    ``df`` has (key, tokens, label, k); ``synonyms`` has (word, synonyms array<string>).
    Returns (key, copy, label, tokens).
    """
    some = df.where(F.col(k_col) >= 1)
    toks = explode_rows(some, [key, label, k_col], tokens_col, "tok", pos="pos")
    syn = synonyms.select(F.col("word").alias("tok"), F.col("synonyms").alias("__syn"))
    toks = toks.join(syn, "tok", "left")
    # one row per document leaves the shuffle; copies multiply after it, in the row
    rows = toks.groupBy(key, label, k_col).agg(F.sort_array(F.collect_list(F.struct("pos", "tok", "__syn"))).alias("__s"))
    copies = rows.select(key, label, "__s", F.explode(F.sequence(F.lit(1), F.col(k_col))).alias("copy"))
    s = F.lit(str(seed))

    def variant(x: Column) -> Column:
        ways = x["__syn"]
        replace = ways.isNotNull() & (F.size(ways) > 0) & ((_u(s, F.col(key), F.col("copy"), x["pos"], F.lit("r")) % 1000) < int(p * 1000))
        pick = F.element_at(ways, ((_u(s, F.col(key), F.col("copy"), x["pos"], F.lit("s")) % F.size(ways)) + 1).cast("int"))
        return F.when(replace, pick).otherwise(x["tok"])

    rebuilt = copies.select(key, "copy", label, F.transform("__s", variant).alias(tokens_col))
    # documents without tokens still get their (empty) copies
    empty = some.where(F.size(tokens_col) == 0).select(key, F.explode(F.sequence(F.lit(1), F.col(k_col))).alias("copy"), label, tokens_col)
    originals = df.select(key, F.lit(0).alias("copy"), label, tokens_col)
    return originals.unionByName(rebuilt).unionByName(empty)


def balance_by_augmentation(df: DataFrame, key: str, tokens_col: str, label: str, synonyms: DataFrame, p: float = 0.3, seed: int = 42) -> DataFrame:
    """Majority class as is, every minority row plus its variants."""
    k = copies_per_sample(df, label).select(label, "k")
    withk = df.join(F.broadcast(k), label)  # one row per class
    return synonym_augment(withk, key, tokens_col, label, synonyms, "k", p, seed)
