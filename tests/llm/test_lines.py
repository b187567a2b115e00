import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from revlens.llm.lines import LINES_SQL, PerfectHash, drop_common_lines, op12_line_dedup

from ..conftest import SF0001


def plain(texts, min_docs, min_chars=1):
    """(n_lines, n_dropped, text) of each text by a dictionary of whole keys."""

    def key(line):
        x = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)

    found = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if found[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_perfect_hash_is_minimal_and_tells_strangers_apart():
    rng = np.random.default_rng(1)
    place, mark = rng.integers(0, 2**63, (2, 20_000)).astype(np.uint64)
    place[:50] = place[50:100]  # keys that differ in the second half only
    held = PerfectHash.build(place, mark, np.arange(20_000) + 1)
    assert sorted(held.numbers(place, mark).tolist()) == list(range(20_000))
    assert held.counts_of(place, mark).tolist() == list(range(1, 20_001))
    strange = rng.integers(0, 2**63, (2, 50_000)).astype(np.uint64)
    assert not held.counts_of(*strange).any()
    assert len(held.words) * 64 < 5 * 20_000
    none = PerfectHash.build(place[:0], mark[:0], np.zeros(0, np.int64))
    assert none.counts_of(place[:3], mark[:3]).tolist() == [0, 0, 0]


ROWS = [
    "Home\n  About us \nown line one", "home\nABOUT US\nÄ line\n\n", "HOME\t\n\x0bhome\nother", "home", " home\nÄ line", None, "", "\n\n",
    "ä line\nabout us", "about us\nunique text " * 3, "x" * 20_000 + "\nhome", "Ä LINE\nä line",
]


@pytest.mark.parametrize("min_docs,min_chars,group", [(2, 1, 128 << 20), (3, 1, 128 << 20), (2, 5, 128 << 20), (2, 1, 1)])
def test_against_a_dictionary(make_docs, min_docs, min_chars, group):
    docs = make_docs(list(enumerate(ROWS * 2))).repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in drop_common_lines(docs, min_docs, min_chars, shard_keys=2, group_bytes=group).collect()}
    assert [got[i] for i in range(len(got))] == plain(ROWS * 2, min_docs, min_chars)


def test_groups_of_shards_agree_with_one(make_docs):
    rows = [f"line {i % 7}\nline {i % 5} b\nown {i}\n line {i % 7}" for i in range(60)]
    docs = make_docs(list(enumerate(rows)))
    one = sorted(map(tuple, drop_common_lines(docs, 9).collect()), key=str)
    many = sorted(map(tuple, drop_common_lines(docs, 9, shard_keys=1, group_bytes=12).collect()), key=str)
    assert one == many and {r[-2] for r in one} == {1, 3}


def test_odd_rows_and_empty_tables(nasty, nasty_rows, empty):
    out = drop_common_lines(nasty, 2)
    assert out.columns == [*nasty.columns, "n_lines", "n_dropped", "dropped_docs"]
    rows = out.collect()
    want = plain([r[1] for r in nasty_rows], 2)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows) == Counter((r[0], *w) for r, w in zip(nasty_rows, want, strict=True))
    assert all(r.sig == "x" and r.lang_pred == "x" for r in rows)
    assert drop_common_lines(empty).count() == 0
    clash = nasty.withColumnRenamed("sig", "n_lines").withColumnRenamed("slot", "row").withColumnRenamed("rank", "a")
    got = drop_common_lines(clash, 2)
    assert got.columns.count("n_lines") == 1 and got.where("row = 'x' and a = 'x'").count() == len(nasty_rows)


def test_query_agrees_with_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    want = con.execute(LINES_SQL).fetchall()
    got = op12_line_dedup(spark, SF0001).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r.n_dropped for r in got) and hashlib.sha256(b"").hexdigest() != got[0].kept_sha256
