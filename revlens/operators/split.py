"""Seeded, exact-size splits, folds and class weights.

Order is a seeded hash ``md5(seed:key)``. Splits by size need no rank at all: the hash of the row at a
cut-off is found by radix selection (``cut_offs``: counts by leading hex digits, then by the digits below
the one bucket that holds the rank), and the split itself is a comparison of hashes in a map.

Where every row needs its rank (folds), an exact global rank never uses an
un-partitioned window over documents: rows are bucketed by the leading hex digits of the
hash, the per-bucket counts (a table bounded by 16**digits rows per partition key) give
cumulative offsets, and ``row_number`` runs only inside a bucket. A hot class is spread
over all buckets, so no task holds more than ~n/16**digits rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_hash(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_bucket(h: Column, digits: int) -> Column:
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")


def exact_rank(
    df: DataFrame,
    key: str,
    seed: int | str = 42,
    partition_cols: tuple[str, ...] = (),
    digits: int = 4,
    rank_col: str = "rank",
    total_col: str | None = "n_total",
    grand_total_col: str | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """1-based rank of each row by (md5(seed:key), key) within ``partition_cols``.

    Adds ``rank_col`` and, when ``total_col`` is set, the partition size. Rows with a null key are left out, or
    come last with ``keep_null_keys``.
    """
    pcols = list(partition_cols)
    h = seeded_hash(F.col(key), seed)
    staged = df.withColumn("__h", h).withColumn("__b", hash_bucket(F.col("__h"), digits))
    if keep_null_keys:
        staged = staged.withColumn("__b", F.coalesce("__b", F.lit(16**digits).cast("bigint")))
    counts = staged.groupBy(*pcols, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    # window over the bucket-count table only (<= 16**digits rows per partition key)
    wcum = Window.partitionBy(*pcols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(wcum), F.lit(0)))
    if total_col:
        offsets = offsets.withColumn(total_col, F.sum("__cnt").over(Window.partitionBy(*pcols)))
    if grand_total_col:
        offsets = offsets.withColumn(grand_total_col, F.sum("__cnt").over(Window.partitionBy()))
    offsets = offsets.drop("__cnt")
    # bounded by 16**digits x partition keys: a proven size, safe to broadcast
    joined = staged.join(F.broadcast(offsets), [*pcols, "__b"])
    within = Window.partitionBy(*pcols, "__b").orderBy("__h", key)
    return joined.withColumn(rank_col, F.col("__off") + F.row_number().over(within)).drop("__h", "__b", "__off")


def ordered_rank(df: DataFrame, order: list, bucket: list, partition_cols: tuple[str, ...] = (), rank_col: str = "rank") -> DataFrame:
    """Exact 1-based rank by ``order`` within ``partition_cols`` without sorting a whole
    partition in one task.

    ``bucket`` is a coarser key, sorted ascending, that is monotone in ``order`` (ordering by
    bucket and then by ``order`` is the same as ordering by ``order``), e.g. ``(-df, prefix of
    term)`` for ``(df desc, term)``. Bucket sizes come from one aggregation; the cumulative
    offsets are a window over the bucket-count table; ``row_number`` runs per bucket.
    """
    pcols = list(partition_cols)
    names = [f"__k{i}" for i in range(len(bucket))]
    staged = df.select("*", *[b.alias(n) for b, n in zip(bucket, names)])
    counts = staged.groupBy(*pcols, *names).agg(F.count(F.lit(1)).alias("__cnt"))
    wcum = Window.partitionBy(*pcols).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(wcum), F.lit(0))).drop("__cnt")
    joined = staged.join(offsets, [*pcols, *names])
    within = Window.partitionBy(*pcols, *names).orderBy(*order)
    return joined.withColumn(rank_col, F.col("__off") + F.row_number().over(within)).drop(*names, "__off")


def cut_offs(df: DataFrame, key: str, seed: int | str, ranks: list[int], digits: int = 4) -> list[str | None]:
    """For each rank the hash of the row that has it in the order of hashes; None for ranks below 1.

    Each step is one aggregation over the keys: counts by the next ``digits`` hex digits within the buckets
    that hold a rank still open, 16 ** digits numbers for each at most. A null key counts as the empty
    hash. A rank beyond the last row gets a hash beyond all.
    """
    h = F.coalesce(seeded_hash(F.col(key), seed), F.lit(""))
    rows = df.select(h.alias("h"))
    found: list[str | None] = [None] * len(ranks)
    open_ = {i: ("", r) for i, r in enumerate(ranks) if r >= 1}  # rank i lies below a prefix, at this rank in it
    while open_:
        prefixes = sorted({p for p, _ in open_.values()})
        n = len(prefixes[0])
        within = rows if not n else rows.where(F.substring("h", 1, n).isin(prefixes))
        counted: dict[str, list[tuple[str, int]]] = {p: [] for p in prefixes}
        for r in within.groupBy(F.substring("h", 1, n + digits).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            counted[r["b"][:n]].append((r["b"], r["n"]))
        for i, (p, rank) in list(open_.items()):
            for bucket, size in sorted(counted[p]):
                if rank <= size:
                    break
                rank -= size
            else:
                bucket = "g" * 32  # after every hex digit
            if len(bucket) < n + digits or len(bucket) >= 32:
                found[i] = bucket
                del open_[i]
            else:
                open_[i] = (bucket, rank)
    return found


def up_to(key: str, seed: int | str, cut: str | None) -> Column:
    """Whether a row lies at or before a cut-off of ``cut_offs``."""
    return F.lit(False) if cut is None else F.coalesce(seeded_hash(F.col(key), seed), F.lit("")) <= F.lit(cut)


# R1 -------------------------------------------------------------------------------------------
def split_exact(
    df: DataFrame, key: str = "doc_id", seed: int = 42, train_frac: float = 0.9, val_frac: float = 0.1, rank_col: str | None = None
) -> DataFrame:
    """train = int(.9 n); validation = first int(.1 train) of it; test = the rest.

    Keys are unique; rows that share a key share their split. With ``rank_col`` every row has its rank too, null
    keys last, and its split follows from the rank, also where rows share a key."""
    if rank_col:
        ranked = exact_rank(df, key, seed, rank_col=rank_col, total_col="__n", keep_null_keys=True)
        n_train = F.floor(F.col("__n") * F.lit(train_frac))
        first = F.when(F.col(rank_col) <= F.floor(n_train * F.lit(val_frac)), F.lit("validation"))
        return ranked.withColumn("split", first.when(F.col(rank_col) <= n_train, F.lit("train")).otherwise(F.lit("test"))).drop("__n")
    n_train = math.floor(df.select(key).count() * train_frac)
    val, train = cut_offs(df, key, seed, [math.floor(n_train * val_frac), n_train])
    split = F.when(up_to(key, seed, val), F.lit("validation")).when(up_to(key, seed, train), F.lit("train")).otherwise(F.lit("test"))
    return df.withColumn("split", split)


# R2 -------------------------------------------------------------------------------------------
def split_threshold(df: DataFrame, key: str = "doc_id", seed: int = 42, train_per_mille: int = 750) -> DataFrame:
    """Stable 75/25 split by hash threshold (no shuffle at all)."""
    b = F.conv(F.substring(seeded_hash(F.col(key), seed), 1, 8), 16, 10).cast("bigint") % 1000
    return df.withColumn("split", F.when(b < train_per_mille, F.lit("train")).otherwise(F.lit("test")))


# R3 -------------------------------------------------------------------------------------------
def carve_validation(df: DataFrame, key: str = "doc_id", seed: int = 42, frac: float = 0.2, split_col: str = "split") -> DataFrame:
    """Move the first int(frac * total) training rows (hash order) to ``validation``."""
    train = F.col(split_col) == "train"
    (cut,) = cut_offs(df.where(train), key, seed, [math.floor(df.select(key).count() * frac)])
    return df.withColumn(split_col, F.when(train & up_to(key, seed, cut), F.lit("validation")).otherwise(F.col(split_col)))


# R5 -------------------------------------------------------------------------------------------
def assign_folds(df: DataFrame, label: str, key: str = "doc_id", k: int = 5, seed: int = 42) -> DataFrame:
    """Stratified folds: within each class rows in hash order are dealt round robin."""
    r = exact_rank(df, key, seed, partition_cols=(label,), total_col=None)
    return r.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank")


# R6 -------------------------------------------------------------------------------------------
def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c); the result has one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    everything = Window.partitionBy()  # over <= k rows
    return counts.withColumn(
        "weight", F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    )


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight", counted: DataFrame | None = None) -> DataFrame:
    """``df`` with the balanced weights of the rows of ``counted`` (all of ``df`` by default); classes
    that have no counted row get a null weight."""
    w = class_weights(df if counted is None else counted, label).select(label, F.col("weight").alias(weight_col))
    return df.join(F.broadcast(w), label, "left")  # one row per class


# O3 -------------------------------------------------------------------------------------------
def clip_corpus(df: DataFrame, frac: float, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """The first floor(n * frac) rows in hash order."""
    (cut,) = cut_offs(df, key, seed, [math.floor(df.select(key).count() * frac)])
    return df.where(up_to(key, seed, cut))


# R4 -------------------------------------------------------------------------------------------
def shuffle_rows(df: DataFrame, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Seeded, reproducible row order (a range-partitioned global sort on the hash); use it
    only where the sink needs a shuffled file order."""
    return df.orderBy(seeded_hash(F.col(key), seed), F.col(key))
