import hashlib
import random
import zlib

import numpy as np
import pytest

from revlens.llm import periodic
from revlens.llm.periodic import find_runs, lyndon_array, op13_periodic_runs, repeated, runs_of
from revlens.llm.registry import table

from ..conftest import SF0001
from .conftest import prose


def plain_runs(words, min_length):
    """Every maximal stretch of every period; one that a smaller period divides into is left out."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j + p - i >= min_length:
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


def plain_lyndon(word):
    """The longest prefix of each suffix that is smaller than all its own proper suffixes."""
    out = []
    for i in range(len(word)):
        best = 1
        for j in range(i + 2, len(word) + 1):
            x = word[i:j]
            if all(x < x[k:] for k in range(1, len(x))):
                best = j - i
        out.append(best)
    return out


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_grouping_gives_the_lyndon_array():
    rng = random.Random(1)
    words = [[], [1], [1, 1, 1], fibonacci(40), thue_morse(40)] + [[rng.randrange(k) for _ in range(rng.randrange(1, 22))] for k in (2, 3, 9) for _ in range(60)]
    for w in words:
        assert lyndon_array(w) == plain_lyndon(w)


@pytest.mark.parametrize("min_length", [2, 3, 5, 12])
def test_runs_against_every_period(min_length):
    rng = random.Random(min_length)
    texts = [[], [3], fibonacci(300), thue_morse(300), [0] * 50, [0, 1] * 30 + [2] + [1, 0] * 20]
    for k in (1, 2, 3, 6):
        for _ in range(40):
            base = [rng.randrange(k) for _ in range(rng.randrange(1, 60))]
            texts.append(base * rng.randrange(1, 4) + [rng.randrange(k) for _ in range(rng.randrange(8))])
    x, y, z = range(6), range(6, 12), range(12, 18)
    texts.append([*x, *y, *x, *z, *y, *z])  # all repeated, and one Lyndon word up to the very end
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = np.array([c for t in texts for c in t], np.int64)
    got = runs_of(ids, at, min_length)
    for t, found in zip(texts, got, strict=True):
        assert found == plain_runs(t, min_length)


def test_long_words_that_collide_in_hashes():
    """Prefix hashes modulo 2**64 can't tell a long Thue-Morse word from its complement; the runs stay right."""
    word = thue_morse(1 << 12)
    word = word + word[:100]
    assert runs_of(np.array(word), np.array([0, len(word)]), 12)[0] == plain_runs(word, 12)


def test_words_left_out_are_in_no_run():
    rng = random.Random(7)
    for _ in range(200):
        w = [rng.randrange(3) for _ in range(60)]
        alive = repeated(np.array(w), np.zeros(60, np.int64), np.full(60, 60), 6)
        for s, n, _ in plain_runs(w, 12):
            assert alive[s : s + n].all()


def plain_document(doc_id, text):
    """The query's row, by its definition."""
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 12)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def test_query_against_its_definition(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF0001, "documents").collect()}
    some = {i: t for i, t in docs.items() if len((t or "").split()) < 2500}
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, SF0001).collect()}
    assert got.keys() == docs.keys() and len(some) > 150
    assert {i: got[i] for i in some} == {i: plain_document(i, t) for i, t in some.items()}
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_odd_rows_and_empty_tables(nasty, nasty_rows, empty):
    clash = nasty.withColumnRenamed("sig", "runs").withColumnRenamed("slot", "row")
    out = find_runs(clash)
    assert out.columns == [c for c in clash.columns if c != "runs"] + ["n_words", "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == len(nasty_rows) and all(r.row == "x" for r in rows)
    for r in rows:
        words = (r.text or "").encode().split()
        assert r.n_words == len(words)
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == plain_runs(words, 12)
        if not r.runs:
            assert r.collapsed.encode() == b" ".join(words)
    assert find_runs(empty).count() == 0


def test_runs_and_collapsed_text(make_docs):
    rows = [(1, "a b " * 6 + "c " + "d " * 12 + "e"), (2, prose(3, 10) + " " + "x y z " * 5), (3, ("p q r " * 4) * 2)]
    got = {r.doc_id: r for r in find_runs(make_docs(rows)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 12, 2), (13, 12, 1)] and got[1].collapsed == "a b c d e"
    assert [tuple(x) for x in got[2].runs] == [(10, 15, 3)] and got[2].collapsed.endswith("x y z")
    assert [tuple(x) for x in got[3].runs] == [(0, 24, 3)] and got[3].collapsed == "p q r"
    assert [tuple(x) for x in {r.doc_id: r for r in find_runs(make_docs(rows), 25).collect()}[1].runs] == []


def test_planted_words_follow_the_rule(spark, make_docs):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    docs = make_docs([(i, prose(i, 5 + i % 37)) for i in ids] + [(None, "a b"), (ids[0], " \n"), (ids[1], None)])
    from pyspark.sql import functions as F

    got = docs.select("doc_id", "text", periodic.planted(F.col("doc_id"), F.col("text")).alias("made")).collect()
    for r in got:
        words = (r.text or "").split()
        g = zlib.crc32(str(r.doc_id).encode()) // 10
        if r.doc_id is None or not words:
            assert r.made == r.text
            continue
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        assert r.made.split() == [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
