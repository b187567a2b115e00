import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.covertree import cover_tree, top_k

SCHEMA = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("score", "string").add("block", "string")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, step, k):
    ok = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % step == 0:
            best = sorted((-int(a @ b), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_tree_covers_its_rows():
    x = np.random.default_rng(0).normal(size=(700, 5))
    x[100:300] = x[50]
    todo = [cover_tree(x, leaf=8, fan=6)]
    assert sorted(todo[0].rows) == list(range(700))
    while todo:
        n = todo.pop()
        assert np.linalg.norm(x[n.rows] - n.center, axis=1).max() <= n.radius + 1e-9
        if n.children:
            assert sorted(r for c in n.children for r in c.rows) == sorted(n.rows)
        todo += n.children


@pytest.mark.parametrize("spread", [1.0, 0.02])
def test_against_brute_force(spark, spread):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + spread * rng.normal(size=8)).tolist()) for i in range(900)]
    rows += [(2000 + i, rows[7][1]) for i in range(150)]  # a vector that many share
    got = top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, k=5, block_rows=100, query_rows=7, pivots=4, seeds=20).collect()
    assert sorted(map(tuple, got)) == brute(rows, 50, 5)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [0.0, 0.0]), (20, [-1.0, -1.0])]
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 10)
    assert top_k(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert top_k(frame(spark, [(10, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0


def test_components_too_large_for_doubles(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * (1e4 if i % 7 else 3e5)).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, [3e30, 1.0, 0.0, 0.0]), (101, [-3e30, 1.0, 0.0, 0.0]), (102, [0.0, 5.0, 1.0, 1.0])]
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=5).collect()
    held = {i: [max(-(2**63 - 1024), min(2**63 - 1024, math.floor(1024 * float(np.float32(x))))) for x in v] for i, v in rows}
    want = []
    for q, a in held.items():
        if q % 10 == 0:
            scores = {i: max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))) for i, b in held.items() if i != q}
            want += [(q, n + 1, i, scores[i]) for n, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:5])]
    assert sorted(map(tuple, got)) == sorted(want)
