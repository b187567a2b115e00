"""Distributed randomised SVD against a dense one; saving and folding in."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import svd as LS


def _entries(spark, seed=0):
    rng = np.random.default_rng(seed)
    dense = {}
    rows = []
    for g, (n, m) in {"a": (60, 40), "b": (25, 70), "low": (12, 9)}.items():
        x = rng.random((n, m)) * (rng.random((n, m)) < 0.25)
        if g == "low":
            x = np.outer(np.arange(1, n + 1), np.arange(m)) + np.outer(np.ones(n), np.arange(m) ** 2)
        dense[g] = x
        rows += [(g, int(i), f"t{j:03d}", float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return dense, spark.createDataFrame(rows, "g string, doc long, term string, w double")


def _v(model, g, m):
    out = np.zeros((m, len(model.singular[g])))
    for r in model.terms.where(F.col("g") == g).collect():
        out[int(r["term"][1:])] = r["v"]
    return out


def test_against_a_dense_svd(spark, tmp_path):
    dense, entries = _entries(spark)
    model = LS.fit_lsi(entries.repartition(5), "g", "doc", "term", "w", 5, oversample=10, tol=1e-9)
    assert len(model.singular["low"]) == 2  # its rank
    for g, x in dense.items():
        u, s, vt = np.linalg.svd(x)
        k = len(model.singular[g])
        assert np.abs(np.array(model.singular[g]) - s[:k]).max() < 1e-6 * s[0]
        v = _v(model, g, x.shape[1])
        assert np.abs(v.T @ v - np.eye(k)).max() < 1e-8
        assert np.abs(np.abs((v * vt[:k].T).sum(0)) - 1).max() < 1e-4
        assert all(v[np.abs(v[:, t]).argmax(), t] > 0 for t in range(k))
    again = LS.load_lsi(spark, LS.save_lsi(model, str(tmp_path / "m")))
    assert again.singular == model.singular
    got = {(r["g"], r["doc"]): np.array(r["coordinates"]) for r in LS.fold_in(again, entries, "doc", "term", "w").collect()}
    for g, x in dense.items():
        v, s = _v(model, g, x.shape[1]), np.array(model.singular[g])
        for i, row in enumerate(x @ v / s):
            assert np.abs(got[g, i] - row).max() < 1e-9
    new = spark.createDataFrame([("a", 900, "t001", 1.0), ("a", 900, "unknown", 5.0), ("b", 901, "unknown", 1.0)], "g string, doc long, term string, w double")
    rows = LS.fold_in(again, new, "doc", "term", "w").collect()
    assert [r["doc"] for r in rows] == [900] and np.abs(np.array(rows[0]["coordinates"]) - _v(model, "a", 40)[1] / np.array(model.singular["a"])).max() < 1e-12
    top = LS.lsi_topics(model, "term", 3).where("g = 'b' and topic = 0").orderBy("rank").collect()
    v = _v(model, "b", 70)[:, 0]
    assert [r["term"] for r in top] == [f"t{j:03d}" for j in np.argsort(-np.abs(v))[:3]]


@pytest.mark.parametrize("parts", [1, 70])
def test_tree_qr_keeps_singular_values(spark, parts):
    x = np.random.default_rng(parts).normal(size=(400, 6))
    df = spark.createDataFrame([("a" if i % 3 else "b", v.tolist()) for i, v in enumerate(x)], "g string, v array<double>").repartition(parts)
    got = LS.tree_qr(df, "g", 6)
    for g, rows in (("a", x[[i for i in range(400) if i % 3]]), ("b", x[::3])):
        assert np.abs(np.linalg.svd(got[g])[1] - np.linalg.svd(rows)[1]).max() < 1e-10


def test_nothing(spark):
    none = spark.createDataFrame([], "g string, doc long, term string, w double")
    model = LS.fit_lsi(none, "g", "doc", "term", "w", 3)
    assert model.singular == {} and model.terms.count() == 0 and LS.fold_in(model, none, "doc", "term", "w").count() == 0


def test_rounds_move_the_terms_of_blocks_and_no_documents(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.random((600, 25)) * (rng.random((600, 25)) < 0.3) * 0.5 ** np.arange(25)
    rows = [("a", int(i), f"t{j:03d}", float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    # a place given twice counts with both weights, a row without a key or weight not at all
    rows += [("a", 0, "t001", 0.5), ("a", None, "t001", 9.0), ("a", 1, None, 9.0), (None, 1, "t001", 9.0), ("a", 1, "t001", None)]
    x[0, 1] += 0.5
    entries = spark.createDataFrame(rows, "g string, doc long, term string, w double")
    monkeypatch.setattr(LS, "SMALL_CELLS", 1)
    sizes, written = [], LS._written

    def counted(df, name):
        out = written(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(LS, "_written", counted)
    model = LS.fit_lsi(entries, "g", "doc", "term", "w", 3, oversample=4, tol=1e-8, block_cells=1200)
    blocks = max(-(-len(rows) // 1200), spark.sparkContext.defaultParallelism)
    assert 25 + blocks * 7 < 600
    rounds = [n for name, n in sizes if name not in ("lsi-entries", "lsi-blocks")]
    assert len(rounds) > 4 and max(rounds) <= 25 + blocks * 7  # vectors of terms and small triangles
    _, s, vt = np.linalg.svd(x)
    assert np.abs(np.array(model.singular["a"]) - s[:3]).max() < 1e-6 * s[0]
    assert np.abs(np.abs((_v(model, "a", 25) * vt[:3].T).sum(0)) - 1).max() < 1e-4
