import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import types as T

from revlens.llm.reversed_search import RANK_SQL, op11_reversed_search, rank_documents, terms_of

from ..conftest import SF0001
from .conftest import prose

ITEMS = T.StructType().add("item_id", "long").add("text", "string").add("score", "string").add("rank", "string").add("term", "string")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(items, docs, k):
    """Every document scored for every item with dictionaries."""
    words = [split(t) for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for item_id, text in dict.fromkeys(items):
        scored = []
        for (doc_id, _), w in zip(docs, words, strict=True):
            tf = Counter(w)
            m = 75 + (25 * len(w) * n_docs) // n_terms if n_terms else 0
            s = 0
            for t in split(text):
                if tf[t]:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_terms():
    assert terms_of("Ab_c-ÀB\x7fx1 日本".encode()) == [x.encode() for x in ["ab", "c", "Àb", "x1", "日本"]]
    assert terms_of(None) == [] and terms_of(b"") == [] and terms_of(b" -- ") == []
    text = "".join(map(chr, range(0x500)))
    assert [t.decode() for t in terms_of(text.encode())] == split(text)


@pytest.mark.parametrize("block_bytes", [64 << 20, 900, 1])
def test_against_dictionaries(spark, nasty, nasty_rows, block_bytes):
    items = [(1, prose(2, 40)), (2, "word"), (2, "word"), (2, "Ünïcödé ΣΑΣ word word"), (3, None), (4, ""), (None, "only a text"), (5, "absent zzzzqqq"), (6, prose(1, 300))]
    frame = spark.createDataFrame([(*i, "x", "y", "z") for i in items], ITEMS)
    docs = [(r[0], r[1]) for r in nasty_rows]
    got = Counter(map(tuple, rank_documents(frame, nasty, 3, block_bytes=block_bytes).collect()))
    assert got == plain(items, docs, 3)


def test_ties_copies_and_many_tasks(spark, make_docs):
    rows = [(i, ["alpha beta", "beta gamma gamma", "alpha", "delta"][i % 4]) for i in range(400)]
    items = [(1, "alpha gamma"), (2, "beta"), (3, "delta alpha beta")]
    frame = spark.createDataFrame([(*i, "", "", "") for i in items], ITEMS)
    got = rank_documents(frame, make_docs(rows).repartition(23), 7).collect()
    assert Counter(map(tuple, got)) == plain(items, rows, 7)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank) if r.item_id == 2] == [0, 4, 8, 12, 16, 20, 24]


def test_empty_tables(spark, nasty, empty):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "word", "", "", "")], ITEMS)
    assert rank_documents(none, nasty).count() == 0 and rank_documents(some, empty).count() == 0
    assert rank_documents(some, nasty).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_agrees_with_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    want = con.execute(RANK_SQL).fetchall()
    got = op11_reversed_search(spark, SF0001).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) > 100
