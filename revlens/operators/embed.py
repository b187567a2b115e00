"""Word vectors and document pooling.

Pooling explodes tokens, pre-aggregates (doc, word) counts so a frequent word is shuffled
once per document, joins the vector table on the word (AQE: broadcast when the table is
small at run time, else a shuffle join with skew splitting) and sums vectors per document
in one hash aggregate with a plain sum per dimension.
"""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.arrays import explode_rows


def _zeros(dim: int):
    return F.array_repeat(F.lit(0.0), dim)


def _pool(doc_words: DataFrame, key: str, vectors: DataFrame, weight_expr, divisor_expr, dim: int) -> DataFrame:
    """Per-document ``sum(weight * vec) / sum(divisor)`` as one aggregate with one plain sum
    per dimension (exact summation; no per-dimension rows)."""
    vec = vectors.select(F.col("word").alias("term"), F.col("vector").cast("array<double>").alias("__v"))
    j = doc_words.join(vec, "term")
    j = j.withColumn("__w", weight_expr).withColumn("__d", divisor_expr)
    sums = [F.sum(F.col("__v")[i] * F.col("__w")).alias(f"__s{i}") for i in range(dim)]
    agg = j.groupBy(key).agg(*sums, F.sum("__d").alias("__n"))
    return agg.select(key, F.array(*[F.col(f"__s{i}") / F.col("__n") for i in range(dim)]).alias("embeds"))


def mean_pool(df: DataFrame, key: str, tokens_col: str, vectors: DataFrame, dim: int) -> DataFrame:
    """mean of the vectors of in-vocabulary token occurrences; zeros when there are none.

    Not ``Word2VecModel.transform``, which divides by all tokens including unknown ones.
    """
    words = explode_rows(df, [key], tokens_col, "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    pooled = _pool(words, key, vectors, F.col("tf").cast("double"), F.col("tf"), dim)
    out = df.join(pooled, key, "left")
    return out.withColumn("embeds", F.coalesce(F.col("embeds"), _zeros(dim)))


def idf_pool(df: DataFrame, key: str, tokens_col: str, vectors: DataFrame, idf: DataFrame, dim: int) -> DataFrame:
    """``mean(vec * idf)`` over in-vocabulary occurrences; the divisor is the number of
    occurrences, and a word without an IDF weight takes the largest IDF."""
    max_idf = idf.agg(F.max("idf")).scalar()  # scalar subquery
    words = explode_rows(df, [key], tokens_col, "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    words = words.join(idf, "term", "left").withColumn("idf", F.coalesce(F.col("idf"), max_idf))
    pooled = _pool(words, key, vectors, F.col("tf") * F.col("idf"), F.col("tf"), dim)
    out = df.join(pooled, key, "left")
    return out.withColumn("embeds", F.coalesce(F.col("embeds"), _zeros(dim)))


def train_word2vec(df: DataFrame, tokens_col: str, vector_size: int = 100, window: int = 5, min_count: int = 5, seed: int = 42, max_iter: int = 1, partitions: int | None = None):
    """skip-gram word vectors over token arrays (``pyspark.ml.feature.Word2Vec``).

    Trained in as many partitions as the input has unless ``partitions`` says otherwise."""
    partitions = partitions or max(1, df.rdd.getNumPartitions())
    w2v = Word2Vec(numPartitions=partitions, vectorSize=vector_size, windowSize=window, minCount=min_count, seed=seed, maxIter=max_iter, inputCol=tokens_col, outputCol="__w2v")
    return w2v.fit(df.select(tokens_col))


def word_vectors(model) -> DataFrame:
    """(word, vector array<double>) from a fitted Word2Vec model (distributed table)."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def char_ngrams(word, n_min: int = 3, n_max: int = 6):
    """Character n-grams of ``<word>`` for n in [n_min, n_max] as an array column."""
    w = F.concat(F.lit("<"), word, F.lit(">"))
    L = F.length(w)
    grams = [
        F.transform(F.sequence(F.lit(1), F.greatest(L - n + 1, F.lit(1))), lambda i, n=n: F.substring(w, i, n))
        for n in range(n_min, n_max + 1)
    ]
    return F.filter(F.array_distinct(F.flatten(F.array(*grams))), lambda g: F.length(g) >= n_min)


def subword_vectors(vectors: DataFrame, words: DataFrame, dim: int, n_min: int = 3, n_max: int = 6) -> DataFrame:
    """F2 (approximation of sub-word models): an n-gram's vector is the mean of the vectors
    of known words containing it; an unseen word's vector is the mean over its n-grams.
    Returns (word, vector) for every word of ``words`` (known words keep their vector)."""
    known = vectors.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("v"))
    kg = known.select("v", F.explode(char_ngrams(F.col("word"), n_min, n_max)).alias("g"))
    gram_vec = kg.groupBy("g").agg(Summarizer.mean(F.col("v")).alias("gv"))
    unseen = words.select("word").distinct().join(vectors.select("word"), "word", "left_anti")
    ug = unseen.select("word", F.explode(char_ngrams(F.col("word"), n_min, n_max)).alias("g"))
    est = ug.join(gram_vec, "g").groupBy("word").agg(Summarizer.mean(F.col("gv")).alias("v"))
    est = unseen.join(est, "word", "left").select(
        "word", F.when(F.col("v").isNull(), _zeros(dim)).otherwise(vector_to_array("v")).alias("vector")
    )
    return vectors.select("word", F.col("vector").cast("array<double>").alias("vector")).unionByName(est)


def features(df: DataFrame, embeds_col: str = "embeds", out_col: str = "features") -> DataFrame:
    """dense ML vector column from an ``array<double>`` embedding."""
    return df.withColumn(out_col, array_to_vector(F.col(embeds_col)))
