"""Sharding: a uniform shuffle with exact shard sizes by a hypergeometric communication matrix.

1. Rows are dealt to blocks by a hash of their key columns; the rows of each block are counted.
2. The driver draws, from those counts and the exact shard sizes alone, how many rows of each block
   go to each shard: a multivariate hypergeometric row per block, drawn without replacement from the
   sizes that the blocks before it have left. That is the law of a uniform permutation of all rows.
3. Each block is permuted (order of a second hash) and its first rows go to shard 0, the next to
   shard 1 and so on, as many as its matrix row says.
4. After the exchange each shard is permuted again (a third hash), which gives the slots.

Only DataFrame functions run on the executors. The driver holds one count per block and the matrix:
``blocks x shards`` numbers, where a block has about ``rows_per_block`` rows (64 blocks at least).
A shard is ordered in buckets of about ``rows_per_block`` rows, so no task sorts a whole shard; their
offsets come from a count that moves hashes only. All choices are hashes of the content and ``seed``:
a retried or recomputed task makes the same ones, whatever the files' layout.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.registry import query, table

SHARDS = 40


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement from ``good + bad`` items are good.

    Inversion outwards from the mode; there is no upper limit on the population.
    """
    lo, hi = max(0, n - bad), min(n, good)
    if lo == hi:
        return lo
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), lo), hi)

    def log_choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    p = math.exp(log_choose(good, mode) + log_choose(bad, n - mode) - log_choose(good + bad, n))
    left, right, p_left, p_right = mode, mode, p, p
    u = rng.random() - p
    while u >= 0 and (left > lo or right < hi):
        if left > lo:
            p_left *= left * (bad - n + left) / ((good - left + 1) * (n - left + 1))
            left -= 1
            u -= p_left
            if u < 0:
                return left
        if right < hi:
            p_right *= (good - right) * (n - right) / ((right + 1) * (bad - n + right + 1))
            right += 1
            u -= p_right
            if u < 0:
                return right
    return mode


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> np.ndarray:
    """Counts by block and shard; its row sums are ``block_rows`` and its column sums ``shard_rows``."""
    rng = np.random.default_rng(seed)
    left = list(shard_rows)
    out = np.zeros((len(block_rows), len(shard_rows)), np.int64)
    for b, n in enumerate(block_rows):
        rest = sum(left)
        for s in range(len(left)):
            rest -= left[s]
            out[b, s] = k = draw_hypergeometric(rng, left[s], rest, n)
            left[s] -= k
            n -= k
    return out


def shard_rows(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def shard_uniform(
    df: DataFrame,
    shards: int = SHARDS,
    keys: tuple[str, ...] = ("doc_id", "text"),
    seed: int = 0,
    rows_per_block: int = 250_000,
    min_blocks: int = 64,
) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one row at most. Rows whose keys are all equal are exchangeable: which of
    them gets which place is open, the places as a whole are not. Nulls in any column count as values
    of their own. Columns of ``df`` that are called shard or slot are replaced. An empty table gives no
    rows; with fewer rows than shards the last shards are empty. Texts of any length move whole.
    """
    spark = df.sparkSession
    total = df.count()
    blocks = max(min_blocks, -(-total // rows_per_block))
    buckets = max(4, -(-total // (shards * rows_per_block)))

    def hashed(salt: int) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(salt), *(F.col(f"`{k}`") for k in keys))

    block = F.pmod(hashed(1), F.lit(blocks)).cast("int")
    counted = {r["block"]: r["n"] for r in df.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("n")).collect()}
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], shard_rows(total, shards), seed)
    bounds = spark.createDataFrame(
        [(b, row) for b, row in enumerate(np.cumsum(matrix, axis=1).tolist())], "block int, bounds array<long>"
    )

    def assigned(rows: DataFrame) -> DataFrame:
        """Permutes each block and cuts it by its row of the matrix."""
        order = Window.partitionBy("block").orderBy("second", "third")
        return (
            rows.withColumn("place", F.row_number().over(order) - 1)
            .join(bounds, "block")
            .withColumn("shard", F.size(F.filter("bounds", lambda x: x <= F.col("place"))))
            .withColumn("bucket", F.pmod("third", F.lit(buckets)).cast("int"))
        )

    hashes = [block.alias("block"), hashed(2).alias("second"), hashed(3).alias("third")]
    sizes = assigned(df.select(*hashes)).groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    order = Window.partitionBy("shard", "bucket").orderBy("third", "second")
    placed = assigned(df.select(F.struct("*").alias("row"), *hashes)).withColumn("nth", F.row_number().over(order) - 1)
    kept = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in ("shard", "slot")]
    return placed.join(offsets, ["shard", "bucket"]).select(
        *kept, F.col("shard").cast("int").alias("shard"), (F.col("offset") + F.col("nth")).cast("long").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; within a file rows are in the order of their slots."""
    sharded.repartition(F.col("shard"), F.floor(F.col("slot") / 250_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return shard_uniform(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
