import random
import re
from collections import Counter

import numpy as np

from revlens.llm.components import connected_components
from revlens.llm.nearjoin import jaccard_join, ngram_sets, runs_needed
from tests.llm.conftest import prose


def grams(text, n=5):
    w = [x for x in re.findall(r"[^\W_]+", (text or "").lower())]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, threshold=0.8):
    """Sorted (doc_id, class_id, n_links) of rows."""
    sets = [grams(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    name = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            name[find(i)] = min(name.get(find(i), k), k)
    none = lambda x: -1 if x is None else x
    return sorted((none(k), none(name.get(find(i))), links[i]) for i, (k, _) in enumerate(rows))


def joined(docs, **how):
    none = lambda x: -1 if x is None else x
    return sorted((none(r.doc_id), none(r.class_id), r.n_links) for r in jaccard_join(docs, **how).collect())


def edited(text, changes, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def test_planted_copies_against_brute_force(make_docs):
    rows = [(i, prose(i, 50 + i % 200)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 7)]
    rows += [(200 + 10 * i + k, edited(rows[i][1], 1 + k, i * 10 + k)) for i in range(0, 60, 3) for k in range(4)]
    shared = prose(999, 30)
    rows += [(1000 + i, prose(500 + i, 60) + " " + shared) for i in range(40)]  # a passage, not copies
    assert joined(make_docs(rows)) == brute(rows)


def test_large_group_of_near_copies_is_split(make_docs):
    base = prose(7, 300)
    rows = [(i, edited(base, 2, i)) for i in range(150)] + [(500 + i, prose(50 + i, 80)) for i in range(20)]
    rows += [(700 + i, prose(90, 12) + " " + prose(300 + i, 25)) for i in range(60)]  # a hot n-gram
    assert joined(make_docs(rows), limit=10, block=16) == brute(rows)


def test_nasty_rows(nasty, nasty_rows, empty, make_docs):
    assert joined(nasty) == brute([(r[0], r[1]) for r in nasty_rows])
    assert jaccard_join(empty).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "One two"), (4, "one TWO!"), (5, "one")]
    assert joined(make_docs(rows)) == brute(rows)


def test_sets_and_runs():
    a, b, c, d = ngram_sets(["A b, c d e f", "a-b c d e f!", None, "a b"])
    assert np.array_equal(a, b) and len(a) == 2 and len(c) == 0 and len(d) == 1
    assert runs_needed(0.9999) > runs_needed(0.99) > 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 300), (300, 200), (400, 401), (402, 401)] + [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**dict.fromkeys(range(41), 0), 200: 200, 300: 200, **dict.fromkeys((400, 401, 402), 400), **dict.fromkeys(range(1000, 1200), 1000)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert Counter(got.values())[1000] == 200
