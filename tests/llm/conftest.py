import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("sig", "shard", "slot", "score", "rank", "block", "factor", "sequence_id", "lang_pred")],
    ]
)
CLASH = ("x",) * 9


def prose(k: int, words: int) -> str:
    """Distinct made-up sentences, the same for the same arguments."""
    out = []
    for i in range(words):
        x = (k * 7919 + i * 104729 + (k + 3) * i * i) % 100003
        out.append("".join("aeioubcdfglmnprst"[(x // 17**j) % 17] for j in range(3 + x % 4)) + ("." if i % 11 == 10 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def nasty_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, odd characters."""
    long_text = prose(1, 30_000)
    return [
        (None, None, None, None, None, *CLASH),
        (None, "only a text here, no id", "en", "s", 5, *CLASH),
        (1, None, "en", "s", 0, *CLASH),
        (2, "", "en", "s", 0, *CLASH),
        (3, "   \n\t ", None, "s", 6, *CLASH),
        (4, "12345 !!! ###", "en", None, 13, *CLASH),
        (5, long_text, "en", "s", len(long_text), *CLASH),
        (6, prose(2, 60), "en", "s", 1, *CLASH),
        (6, prose(2, 60), "en", "s", 1, *CLASH),
        (7, prose(2, 60), "fr", "t", 1, *CLASH),
        (8, "Ünïcödé ΣΑΣ İstanbul \U0001f600 日本語 <|endoftext|> \x00 a", "de", "s", 1, *CLASH),
        (9, "word", "en", "s", 4, *CLASH),
        (10, "x" * 50_000, "en", "s", 50_000, *CLASH),
    ]


@pytest.fixture(scope="session")
def nasty(spark, nasty_rows):
    return spark.createDataFrame(nasty_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", 0, *CLASH) for i, t in rows], DOCS)

    return make
