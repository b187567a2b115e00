from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm.mixing import count_words, form_topic, mix_sources
from tests.conftest import SF001


def shares(rows, by):
    out = Counter()
    for r in rows:
        out[getattr(r, by)] += r.mix_tokens * r.mix_probability
    return {k: v / sum(out.values()) for k, v in out.items()}


def test_expected_shares_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    targets = {"lang": {"=en": 0.4, "=fr": 0.3, "=de": 0.2, "=es": 0.1}}
    rows = mix_sources(docs, targets=targets, sweeps=30).collect()
    assert len(rows) == docs.count()
    got = shares(rows, "lang")
    assert all(abs(got[k[1:]] - v) < 1e-3 for k, v in targets["lang"].items())
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.mix_tokens
    power = {k: v**0.8 for k, v in tokens.items()}
    got = shares(rows, "source")
    assert all(abs(got[k] - v / sum(power.values())) < 1e-3 for k, v in power.items())
    assert max(r.mix_probability for r in rows) == 1
    kept = [r for r in rows if r.mix_kept]
    want = sum(r.mix_probability for r in rows)
    assert abs(len(kept) - want) < 5 * want**0.5


def test_salted_join_equals_broadcast(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cols = ["doc_id", "mix_tokens", "mix_kept", F.round("mix_probability", 12)]
    a = mix_sources(docs, sweeps=2).select(*cols).collect()
    b = mix_sources(docs, sweeps=2, broadcast_cells=0, salt=5).select(*cols).collect()
    assert sorted(a) == sorted(b)


def test_targets_for_sources(spark, make_docs):
    from revlens.llm.mixing import key

    docs = make_docs([(i, "a b c d") for i in range(10)]).withColumn("source", F.when(F.col("doc_id") < 9, "s").otherwise("t"))
    targets = spark.createDataFrame([("s", 0.5), ("t", 0.5)], "v string, share double").select(key(F.col("v")).alias("source"), "share")
    got = {r.doc_id: r.mix_probability for r in mix_sources(docs, source_targets=targets).collect()}
    assert got[9] == 1 and all(abs(got[i] - 1 / 9) < 1e-9 for i in range(9))


def test_a_source_without_tokens_thins_nothing(spark, make_docs):
    docs = make_docs([(i, "a b c d e" * (1 + i % 3)) for i in range(200)])
    docs = docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 4))
    blank = make_docs([(1000, None), (1001, " "), (1002, "")]).withColumn("source", F.lit("blank"))
    alone = {r.doc_id: r.mix_probability for r in mix_sources(docs).collect()}
    got = {r.doc_id: r.mix_probability for r in mix_sources(docs.unionByName(blank)).collect()}
    assert sum(alone.values()) > 100 and all(abs(got[i] - p) < 1e-9 for i, p in alone.items())
    assert all(0.1 < got[i] <= 1 for i in (1000, 1001, 1002))
    assert {r.mix_probability for r in mix_sources(blank).collect()} == {1.0}


@pytest.mark.parametrize("listed", [[("s0", 0.5), ("s1", 0.3)], [("s0", 50.0), ("s1", 30.0), ("s2", 0.0), ("s3", None)]])
def test_a_source_without_a_target_keeps_its_share(spark, make_docs, listed):
    from revlens.llm.mixing import key

    docs = make_docs([(i, "a b c d") for i in range(400)]).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 4))
    targets = spark.createDataFrame(listed, "v string, share double").select(key(F.col("v")).alias("source"), "share")
    rows = mix_sources(docs, source_targets=targets).collect()
    got, want = shares(rows, "source"), {"s0": 0.3125, "s1": 0.1875, "s2": 0.25, "s3": 0.25}
    assert all(abs(got[k] - v) < 1e-6 for k, v in want.items())
    assert sum(r.mix_probability for r in rows) > 300


def test_a_rate_is_met_whatever_the_rarest_cell(spark, make_docs):
    docs = make_docs([(i, "a b c d") for i in range(400)])
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 300, "s").when(F.col("doc_id") < 399, "t").otherwise("tiny"))
    plain = {r.source: r.mix_probability for r in mix_sources(docs).collect()}
    rows = mix_sources(docs, rate=0.8).collect()
    got = {r.source: r.mix_probability for r in rows}
    assert abs(sum(r.mix_probability * r.mix_tokens for r in rows) - 0.8 * 1600) < 1e-6
    assert got["tiny"] == 1 and abs(got["s"] / got["t"] - plain["s"] / plain["t"]) < 1e-9
    assert sum(plain[r.source] for r in rows) < 0.5 * len(rows)
    assert {r.mix_probability for r in mix_sources(docs, rate=1.0).collect()} == {1.0}
    with pytest.raises(ValueError):
        mix_sources(docs, rate=0.0)


@pytest.mark.parametrize("text,words,topic", [(None, 0, "empty"), ("", 0, "empty"), (" \n", 0, "short"), (" a  b\tc\n", 3, "short"), ("a | b", 3, "table"), ("x### y", 2, "marked"), ("w " * 5000, 5000, "long")])
def test_facts(make_docs, text, words, topic):
    assert make_docs([(1, text)]).select(count_words(F.col("text")), form_topic(F.col("text"))).first() == (words, topic)


def test_nasty_rows(nasty, nasty_rows, empty):
    rows = mix_sources(nasty).collect()
    assert len(rows) == len(nasty_rows) and all(0 <= r.mix_probability <= 1 for r in rows)
    assert Counter((r.doc_id, r.text, r.factor) for r in rows) == Counter((r[0], r[1], "x") for r in nasty_rows)
    assert mix_sources(empty).count() == 0


def test_sql_agrees_beside_a_source_without_tokens(spark, make_docs, tmp_path):
    import duckdb

    from revlens.llm.mixing import op8_mixing

    rows = [(i, f"word {i % 7} " * (3 + i % 50)) for i in range(300)] + [(900, None), (901, " "), (902, "x | y"), (903, "a b")]
    docs = make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    source = F.when(F.col("doc_id").isin(900, 901), "bare").when(F.col("doc_id") == 902, None).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 3))
    docs = docs.withColumn("source", source).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    from revlens.llm.mixing import mix_sql

    want = con.execute(mix_sql()).fetchall()
    got = op8_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r.kept for r in got) > 60
