from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from revlens.llm.sharding import communication_matrix, draw_hypergeometric, shard_rows, shard_uniform


def test_matrix_has_exact_margins():
    blocks, shards = [0, 5, 17, 100, 3], shard_rows(125, 7)
    m = communication_matrix(blocks, shards, 3)
    assert m.sum(1).tolist() == blocks and m.sum(0).tolist() == shards and (m >= 0).all()


def test_draws_follow_the_hypergeometric_law():
    rng = np.random.default_rng(1)
    got = np.array([draw_hypergeometric(rng, 30, 70, 20) for _ in range(20000)])
    assert abs(got.mean() - 6) < 0.06
    assert abs(got.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.15
    assert draw_hypergeometric(rng, 10**12, 10**13, 0) == 0
    big = [draw_hypergeometric(rng, 10**12, 10**12, 10**4) for _ in range(200)]
    assert abs(np.mean(big) - 5000) < 20


def check(rows, n, shards):
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == n
    assert [sizes.get(s, 0) for s in range(shards)] == shard_rows(n, shards)
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_nasty_rows_keep_their_columns(nasty, nasty_rows):
    out = shard_uniform(nasty, shards=4)
    assert sorted(out.columns) == sorted(nasty.columns)
    rows = out.collect()
    check(rows, len(nasty_rows), 4)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in nasty_rows)


def test_content_decides_not_layout(make_docs):
    docs = make_docs([(i, f"text {i % 7}") for i in range(500)])
    a = {r.doc_id: (r.shard, r.slot) for r in shard_uniform(docs, shards=6, rows_per_block=20, min_blocks=3).collect()}
    b = {r.doc_id: (r.shard, r.slot) for r in shard_uniform(docs.repartition(9, F.rand(3)), shards=6, rows_per_block=20, min_blocks=3).collect()}
    assert a == b
    c = {r.doc_id: (r.shard, r.slot) for r in shard_uniform(docs, shards=6, seed=1, rows_per_block=20, min_blocks=3).collect()}
    assert a != c


def test_equal_texts_spread(make_docs):
    rows = shard_uniform(make_docs([(i, "same") for i in range(4000)]), shards=10).collect()
    check(rows, 4000, 10)
    first = Counter(r.shard for r in rows if r.doc_id < 1000)
    assert max(first.values()) < 160 and min(first.values()) > 50


def test_small_and_empty(make_docs, empty):
    check(shard_uniform(make_docs([(1, "a"), (2, "b")]), shards=5).collect(), 2, 5)
    assert shard_uniform(empty, shards=5).count() == 0


def test_places_against_a_plain_version(make_docs):
    """The same rows dealt, permuted and cut one after the other, from the hashes alone."""
    seed, shards, rows_per_block, min_blocks = 4, 6, 20, 3
    docs = make_docs([(i, f"text {i % 90}") for i in range(500)])
    blocks, buckets = max(min_blocks, -(-500 // rows_per_block)), max(4, -(-500 // (shards * rows_per_block)))
    hashed = [F.xxhash64(F.lit(seed), F.lit(k), "doc_id", "text").alias(f"h{k}") for k in (1, 2, 3)]
    rows = [(r.doc_id, r.h1 % blocks, r.h2, r.h3) for r in docs.select("doc_id", *hashed).collect()]
    matrix = communication_matrix([sum(r[1] == b for r in rows) for b in range(blocks)], shard_rows(500, shards), seed)
    dealt = {s: [] for s in range(shards)}
    for b in range(blocks):
        own = sorted((r for r in rows if r[1] == b), key=lambda r: r[2:])
        for s in range(shards):
            k = int(matrix[b, s])
            dealt[s] += own[:k]
            own = own[k:]
        assert not own
    want = {}
    for s, own in dealt.items():
        for slot, r in enumerate(sorted(own, key=lambda r: (r[3] % buckets, r[3], r[2]))):
            want[r[0]] = (s, slot)
    got = {r.doc_id: (r.shard, r.slot) for r in shard_uniform(docs, shards=shards, seed=seed, rows_per_block=rows_per_block, min_blocks=min_blocks).collect()}
    assert got == want
