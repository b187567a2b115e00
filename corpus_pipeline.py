"""The corpus pipeline: language ID, near-duplicate removal, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.language import identify
from revlens.llm.mixing import mix_sources
from revlens.llm.nearjoin import jaccard_join
from revlens.llm.packing import pack
from revlens.llm.registry import table
from revlens.llm.tables import cut

#: The share of the clean documents' tokens that mixing keeps.
MIX_RATE = 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the centroids accept; ``lang`` becomes the predicted one.

    Learned from the labelled documents whose id has a remainder other than 1 modulo 3. Null texts, texts
    without a letter and texts far from every centroid go.
    """
    names = [F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns]
    return identify(docs).where(~F.col("rejected")).select(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of the n-gram Jaccard join: the one with the smallest doc_id, ids before none.

    Rows are told apart by a number of their own, so rows that repeat an id, or have none, are judged by
    their texts like all others. Texts without words (null, empty, only marks) are copies of nothing and
    stay. An empty table gives no rows.
    """
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    classes = jaccard_join(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "class_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = classes.join(rows.select("_row", "doc_id"), "_row").groupBy("class_id").agg(F.min(order).alias("m")).select("m._row")
    return rows.join(first, "_row", "left_semi").select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of ``MIX_RATE`` of the tokens, its cells in the raked proportions or, where that is all of one, whole.

    A null source or language is a value of its own; null and blank texts weigh nothing and are kept with
    their cell's probability. The draw depends on the id alone: rows that repeat an id, and rows without
    one, stand or fall together within a cell. An empty table gives no rows.
    """
    return mix_sources(docs, rate=MIX_RATE).where("mix_kept").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document, with its ids.

    A null or empty text is the end token alone. Repeated rows are packed each; very long texts are cut into
    as many pieces as they need. An empty table gives no rows. The workers still hold what earlier stages took,
    so their tables of known pieces are small.
    """
    return pack(docs, most_pieces=100_000)


STAGES = [
    ("language id", identify_language),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing sources", mix_to_targets),
    ("packing", pack_sequences),
]

#: The tokenizer and the fitted centroids are out of SQL's reach; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
