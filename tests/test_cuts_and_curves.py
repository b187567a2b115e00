"""Radix cut-offs, exact curves, centroid scores and batch scoring against plain versions."""

import hashlib
import io
import random
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from revlens.operators import classify as CL
from revlens.operators import evaluate as EV
from revlens.operators import split as S


def _order(keys, seed=42):
    return sorted(keys, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_cut_offs_find_the_ranked_hash(spark, digits):
    n = 1500
    df = spark.createDataFrame([(i,) for i in range(n)], "doc_id long")
    order = _order(range(n))
    ranks = [0, 1, 2, 700, 701, n - 1, n, n + 1]
    got = S.cut_offs(df, "doc_id", 42, ranks, digits)
    want = [None, *[hashlib.md5(f"42:{order[r - 1]}".encode()).hexdigest() for r in ranks[1:-1]]]
    # a cut may stop at a prefix that only rows up to the rank share; both cut the same rows
    for r, a, b in zip(ranks[:-1], got, want):
        inside = [i for i in range(n) if a is not None and hashlib.md5(f"42:{i}".encode()).hexdigest() <= a]
        assert len(inside) == r and (b is None) == (a is None)
    assert df.where(S.up_to("doc_id", 42, got[-1])).count() == n


def test_splits_follow_the_order_and_hold_no_window(spark):
    n = 997
    df = spark.createDataFrame([(i, "train" if i % 3 else "test") for i in range(n)], "doc_id long, part string")
    got = {r["doc_id"]: r["split"] for r in S.split_exact(df).collect()}
    train, val = int(n * 0.9), int(int(n * 0.9) * 0.1)
    order = _order(range(n))
    assert [got[i] for i in order] == ["validation"] * val + ["train"] * (train - val) + ["test"] * (n - train)
    carved = S.carve_validation(df, split_col="part", frac=0.2)
    got = {r["doc_id"]: r["part"] for r in carved.collect()}
    first = _order([i for i in range(n) if i % 3])[: int(n * 0.2)]
    assert {i for i in got if got[i] == "validation"} == set(first)
    clipped = S.clip_corpus(df, 0.5)
    assert {r["doc_id"] for r in clipped.collect()} == set(order[: n // 2])
    for out in (S.split_exact(df), carved, clipped):
        said = io.StringIO()
        with redirect_stdout(said):
            out.explain()
        assert "Window" not in said.getvalue() and "Exchange" not in said.getvalue()


def test_cuts_with_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "doc_id long")
    assert S.clip_corpus(df, 0.25).collect()[0]["doc_id"] is None
    empty = spark.createDataFrame([], "doc_id long")
    assert S.split_exact(empty).count() == 0 and S.clip_corpus(empty, 0.5).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_curve_against_sorting(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(3), [rng.choice([0.1, 0.25, 0.5, rng.random()]) for _ in range(3)]) for _ in range(400)] + [(None, [0.1, 0.2, 0.3])]
    df = spark.createDataFrame(rows, "label int, probability array<double>")
    curve = EV.exact_curve(df, parts=parts)
    got = {(r["class"], r["threshold"]): (r["tp"], r["fp"]) for r in curve.collect()}
    want = {}
    for k in range(3):
        for t in {p[k] for y, p in rows if y is not None}:
            up = [y for y, p in rows if y is not None and p[k] >= t]
            want[k, t] = (sum(y == k for y in up), sum(y != k for y in up))
    assert got == want
    areas = {r["class"]: (r["auc"], r["average_precision"]) for r in EV.curve_areas(curve).collect()}
    for k in range(3):
        pos = [p[k] for y, p in rows if y == k]
        neg = [p[k] for y, p in rows if y is not None and y != k]
        auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
        assert abs(areas[k][0] - auc) < 1e-12
        points = sorted((t for c, t in want if c == k), reverse=True)
        ap, last = 0.0, 0
        for t in points:
            tp, fp = want[k, t]
            ap += (tp - last) / len(pos) * tp / (tp + fp)
            last = tp
        assert abs(areas[k][1] - ap) < 1e-12


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [0.5])], "label int, probability array<double>")
    r = EV.curve_areas(EV.exact_curve(df)).first()
    assert r["auc"] is None and r["average_precision"] == 1.0


def test_batch_score_equals_transform(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    y = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 0.5)
    rows = [(i, int(k), v.tolist()) for i, (k, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "doc_id long, label int, embeds array<double>").repartition(3).withColumn("features", array_to_vector("embeds"))
    model = LogisticRegression(regParam=0.01).fit(df)
    make = CL.linear_scorer(model.coefficientMatrix.toArray(), model.interceptVector.toArray())
    got = CL.batch_score(df, "embeds", make, 5, batch_bytes=8 * 5 * 7)
    both = got.select("doc_id", F.col("prediction").alias("own")).join(model.transform(df).select("doc_id", "prediction"), "doc_id")
    assert both.count() == 300 and both.where("own <> prediction").isEmpty()


def test_centroids(spark):
    rows = [(0, [0.0, 0.0]), (0, [2.0, 0.0]), (1, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "label int, x array<double>")
    got = CL.centroid_scores(df, CL.fit_centroids(df, "label", "x", 2), "x").orderBy("label", F.col("x")[0]).collect()
    assert [r["logits"] for r in got] == [[-1.0, -50.0], [-1.0, -34.0], [-41.0, -0.0]]


def test_exact_split_with_ranks(spark):
    n = 211
    df = spark.createDataFrame([(i,) for i in [*range(n), 7, None]], "doc_id long")
    order = [*_order([*range(n), 7]), None]
    got = sorted(((r["rank"], r["doc_id"], r["split"]) for r in S.split_exact(df, rank_col="rank").collect()))
    n_train = int(len(order) * 0.9)
    want = [(i + 1, k, "validation" if i < int(n_train * 0.1) else "train" if i < n_train else "test") for i, k in enumerate(order)]
    assert got == want


def test_split_exact_query_gives_every_rank(spark, tmp_path):
    from __spark_entry__ import oracle_sql, queries

    rows = [(i, "a b", "en", "web", 3) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["split_exact"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "rank", "split"] and "SELECT doc_id, rank, CASE" in oracle_sql()["split_exact"]
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == _order(range(40))
