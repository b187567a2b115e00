import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.nndescent import nearest, op9_nearest_neighbours
from tests.conftest import SF001

SCHEMA = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("node", "string").add("sim", "string")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, step, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, a in ok:
        if q % step == 0:
            out[q] = [i for _, i in sorted((-float(a @ b), i) for i, b in ok if i != q)[:k]]
    return out


def lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert len(out[r.query_id]) == r.rank
    return out


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = op9_nearest_neighbours(spark, SF001).collect()
    want, found = brute(rows, 20, 20), lists(got)
    assert set(want) == set(found)
    assert sum(len(set(want[q]) & set(found[q])) for q in want) >= 0.95 * sum(map(len, want.values()))
    vectors = {i: np.array(v, float) for i, v in rows}
    assert all(abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12 for r in got)


def test_descent_finds_neighbours_beyond_the_first_chunks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1500)]
    how = dict(k=10, degree=12, tables=1, chunk=32, beam=24)
    want = brute(rows, 20, 10)
    found = lists(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, **how).collect())
    assert sum(len(set(want[q]) & set(found[q])) for q in want) >= 0.9 * sum(map(len, want.values()))
    joined = lists(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, broadcast_mb=0, **how).collect())
    assert sum(len(set(want[q]) & set(joined[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_copies_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.0, 1.0 + i]) for i in range(3)]
    odd = [(200, None), (201, [None, 1.0]), (202, [0.0, 0.0]), (203, [float("nan"), 1.0]), (204, [1.0]), (None, [1.0, 1.0])]
    found = lists(nearest(frame(spark, rows + odd), F.col("vec_id") % 20 == 0).collect())
    assert found == brute(rows, 20, 20)
    few = lists(nearest(frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [0.5, 0.5])]), F.col("vec_id") % 20 == 0).collect())
    assert few == {0: [1, 20], 20: [0, 1]}
    assert nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_each_length_is_searched(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(200)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(41)]
    found = lists(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())
    want = brute(rows[:200], 20, 20) | brute(rows[200:], 20, 20)
    assert found.keys() == want.keys()
    assert sum(len(set(want[q]) & set(found[q])) for q in want) >= 0.95 * sum(map(len, want.values()))
