import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from revlens.llm import katz
from tests.conftest import SF0001
from tests.llm.conftest import prose

LOWER = {i: i + 32 for i in range(65, 91)}


class Plain:
    """The same model by dictionaries."""

    def __init__(self, texts):
        train = [self.tokens(t) for t in texts]
        self.c1 = Counter(w for t in train for w in t)
        self.c2 = Counter(p for t in train for p in zip([None, *t], t))
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.count = {**self.c1, None: len(train)}
        of = lambda c: katz.discounts([0, *(sum(x == r for x in c.values()) for r in range(1, katz.CUTOFF + 2))])
        self.d1, self.d2 = of(self.c1), of(self.c2)
        self.uni = {w: (self.d1[c] if c <= katz.CUTOFF else 1) * c / (self.n + 1) for w, c in self.c1.items()}
        self.unk = 1 - sum(self.uni.values())
        seen, low = Counter(), Counter()
        for a, b in self.c2:
            seen[a] += self.seen(a, b)
            low[a] += self.uni[b]
        self.alpha = {a: (1 - seen[a]) / (1 - low[a]) for a in seen}

    @staticmethod
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["</end>"]

    def seen(self, a, b):
        c = self.c2[(a, b)]
        return (self.d2[c] if c <= katz.CUTOFF else 1) * c / (self.count[a] + 1)

    def p(self, a, b):
        return self.seen(a, b) if (a, b) in self.c2 else self.alpha.get(a, 1) * self.uni.get(b, self.unk)

    def score(self, text):
        t = self.tokens(text)
        return sum(math.log10(self.p(a, b)) for a, b in zip([None, *t], t))

    def base(self, text):
        return sum(math.log10((self.c1[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in self.tokens(text))


def check(rows, texts_by_row):
    plain = Plain([t for _, t, held in texts_by_row if not held])
    key = lambda i, t, held: (-1 if i is None else i, held, len(plain.tokens(t)), round(plain.base(t), 6), round(plain.score(t), 6))
    want = sorted(key(*x) for x in texts_by_row)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows)
    for w, g in zip(want, got, strict=True):
        assert w[:3] == g[:3] and np.allclose(w[3:], g[3:], rtol=1e-7, atol=1e-5), (w, g)
    assert {r.train_tokens for r in rows} <= {plain.n}
    return plain


def test_corpus_against_dictionaries(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = katz.katz_scores(docs, F.col("doc_id") % 5 == 1, slab_chars=100_000, bucket_tokens=3_000, ranges=5).collect()
    texts = [(r.doc_id, r.text, r.doc_id % 5 == 1) for r in docs.select("doc_id", "text").collect()]
    plain = check(rows, texts)
    known = {r.doc_id: r.n_known for r in rows}
    assert all(known[i] == sum(w in plain.c1 for w in plain.tokens(t)) for i, t, _ in texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    plain = Plain([prose(1, 80), prose(1, 80) + " more", "a b a b a b a b a b a b a b", ""])
    for a in [None, "a", "b", "never", *list(plain.c1)[:10]]:
        total = sum(plain.p(a, b) for b in plain.c1) + plain.p(a, "never seen")
        assert abs(total - 1) < 1e-9


def test_nasty_rows(nasty, nasty_rows):
    rows = katz.katz_scores(nasty, F.col("doc_id") % 5 == 1, slab_chars=60_000, bucket_tokens=500, ranges=3).collect()
    check(rows, [(r[0], r[1], r[0] is not None and r[0] % 5 == 1) for r in nasty_rows])


def test_crowded_contexts_are_split(make_docs):
    texts = [(i, " ".join(f"the w{(i * 31 + k * k) % 97}" for k in range(60)) + (" the new" if i % 5 == 1 else "")) for i in range(40)]
    rows = katz.katz_scores(make_docs(texts), F.col("doc_id") % 5 == 1, slab_chars=900, bucket_tokens=100, ranges=3).collect()
    check(rows, [(i, t, i % 5 == 1) for i, t in texts])


def test_nothing_to_learn(empty, make_docs):
    held = F.lit(True)
    assert katz.katz_scores(empty, held).count() == 0
    rows = katz.katz_scores(make_docs([(1, "a b"), (2, None)]), held).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_discounts():
    n = [0, 1000, 400, 200, 120, 80, 60]
    d = katz.discounts(n)
    rest = 6 * 60 / 1000
    assert abs(d[1] - (2 * 400 / 1000 - rest) / (1 - rest)) < 1e-12
    for odd in ([0] * 7, [0, 1, 0, 0, 0, 0, 0], [0, 5, 0, 9, 0, 0, 3]):
        assert all(0 < x <= 1 for x in katz.discounts(odd))
