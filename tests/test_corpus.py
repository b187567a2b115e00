"""Fixtures and brute-force checks."""

import math
import random

from pyspark.sql import functions as F

from revlens.operators import augment as AU
from revlens.operators import coherence as CO
from revlens.operators import embed as EM
from revlens.operators import evaluate as EV
from revlens.operators import gsdmm as GS
from revlens.operators import ngrams as NG
from revlens.operators import split as S
from revlens.operators import vocab as V


# R1 / R5 / R6 ------------------------------------------------------------------------------------
def _ids(spark, n):
    return spark.createDataFrame([(i,) for i in range(n)], "doc_id long")


def test_split_exact_sizes(spark):
    for n, sizes in [(1000, (810, 90, 100)), (11, (9, 0, 2))]:
        out = S.split_exact(_ids(spark, n)).groupBy("split").count().collect()
        got = {r["split"]: r["count"] for r in out}
        assert (got.get("train", 0), got.get("validation", 0), got.get("test", 0)) == sizes


def test_exact_rank_equals_sorted_hash(spark):
    import hashlib

    n = 3000
    ranks = {r[0]: r[1] for r in S.exact_rank(_ids(spark, n), "doc_id", 42, digits=2).select("doc_id", "rank").collect()}
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    assert [ranks[i] for i in order] == list(range(1, n + 1))


def test_folds_stratified_and_weights(spark):
    rows = [(i, 0) for i in range(51)] + [(100 + i, 1) for i in range(49)] + [(200 + i, 2) for i in range(299)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    f = S.assign_folds(df, "label").groupBy("label", "fold").count().collect()
    for lab in (0, 1, 2):
        sizes = sorted(r["count"] for r in f if r["label"] == lab)
        assert len(sizes) == 5 and sizes[-1] - sizes[0] <= 1
    w = {r["label"]: r["weight"] for r in S.class_weights(df, "label").collect()}
    assert round(w[0], 6) == 2.607843 and round(w[1], 6) == 2.714286 and round(w[2], 6) == 0.444816
    assert abs(sum(w[k] * c for k, c in [(0, 51), (1, 49), (2, 299)]) - 399) < 1e-9


def test_labelled_tokens_cleans_labelled_texts_once(spark, tmp_path):
    """The label join lies below the cleaning and the result is kept; repeated keys meet as in the SQL."""
    from revlens.plans.q_corpus import labelled_tokens

    docs = [(1, "apple pie"), (2, "banana"), (2, "cherry"), (3, "unlabelled"), (None, "no key")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    lt = labelled_tokens(spark, str(tmp_path))
    assert lt.columns == ["doc_id", "toks", "sentiment"] and lt.storageLevel.useMemory
    got = sorted((r["doc_id"], r["sentiment"], tuple(r["toks"])) for r in lt.collect())
    assert got == [(1, 0, ("apple", "pie"))] + [(2, 2, ("banana",))] * 2 + [(2, 2, ("cherry",))] * 2
    plan = lt._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryTableScan" not in plan and plan.index("translate(") < plan.index("Join")
    lt.unpersist()


# N1 / N2 -----------------------------------------------------------------------------------------
def test_phrase_score_formula():
    # c_ab=30, min=20, |V|=500, c_a=40, c_b=50 -> 2.5 ; |V|=5000 -> 25
    assert (30 - 20) * 500 / (40 * 50) == 2.5 and (30 - 20) * 5000 / (40 * 50) == 25


def test_merge_sends_a_small_phrase_table_to_the_pairs(spark):
    """The phrase table's size is known when the merge is planned, so the pairs of all documents are not shuffled."""
    rng = random.Random(3)
    rows = [(i, "new york".split() + [rng.choice("abcdefghij") * 2 for _ in range(12)]) for i in range(60)]
    out = NG.bigrams(spark.createDataFrame(rows, "doc_id int, toks array<string>"), "doc_id", "toks", "m", 5, 1.0)
    got = {r["doc_id"]: r["m"] for r in out.collect()}
    assert all(got[i][0] == "new_york" and got[i][1:] == NG.greedy_merge_python(t[2:], set()) for i, t in rows)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert [x for x in plan.splitlines() if "LeftSemi" in x and "BroadcastHashJoin" in x] and "/phrases-" in plan


def test_greedy_merge_cases(spark):
    ph = spark.createDataFrame([("a", "b"), ("b", "a")], "a string, b string")
    docs = spark.createDataFrame([(1, "a b a b a".split()), (2, "b a b".split()), (3, [])], "doc_id int, toks array<string>")
    out = {r[0]: r[1] for r in NG.apply_phrases(docs, "doc_id", "toks", ph, "m").select("doc_id", "m").collect()}
    assert out == {1: ["a_b", "a_b", "a"], 2: ["b_a", "b"], 3: []}


def test_greedy_merge_matches_python(spark):
    rng = random.Random(5)
    vocab = list("abcde")
    phrases = {(x, y) for x in vocab for y in vocab if rng.random() < 0.35}
    docs = [(i, [rng.choice(vocab) for _ in range(rng.randint(0, 25))]) for i in range(200)]
    ph = spark.createDataFrame(sorted(phrases), "a string, b string")
    df = spark.createDataFrame(docs, "doc_id int, toks array<string>")
    out = {r[0]: r[1] for r in NG.apply_phrases(df, "doc_id", "toks", ph, "m").select("doc_id", "m").collect()}
    for i, toks in docs:
        assert out[i] == NG.greedy_merge_python(toks, phrases)


def test_score_phrases_brute_force(spark):
    rng = random.Random(9)
    docs = [[rng.choice("abcdef") for _ in range(rng.randint(0, 30))] for _ in range(300)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id int, toks array<string>")
    got = {(r["a"], r["b"]): r["score"] for r in NG.score_phrases(df, "toks", 20, 1.0).collect()}
    uni, big = {}, {}
    for d in docs:
        for t in d:
            uni[t] = uni.get(t, 0) + 1
        for x, y in zip(d, d[1:]):
            big[(x, y)] = big.get((x, y), 0) + 1
    vsize = len(set(uni) | {f"{x}_{y}" for x, y in big})
    want = {}
    for (x, y), c in big.items():
        s = (c - 20) * vsize / (uni[x] * uni[y])
        if s > 1.0:
            want[(x, y)] = s
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


# B1 / B3 / B4 ------------------------------------------------------------------------------------
def test_filter_extremes_bounds(spark):
    rows = []
    for d in range(100):
        toks = ["t19"] * (d < 19) + ["t20"] * (d < 20) + ["t50"] * (d < 50) + ["t51"] * (d < 51)
        rows.append((d, "g", toks))
    df = spark.createDataFrame(rows, "doc_id int, g string, toks array<string>")
    kept = {r["term"] for r in V.filter_extremes(df, "doc_id", "toks", ["g"]).collect()}
    assert kept == {"t20", "t50"}


def test_tfidf_topic_fixture(spark):
    bow = spark.createDataFrame(
        [(0, "x", 2), (0, "y", 1), (0, "z", 1), (1, "y", 1), (1, "z", 1), (2, "z", 1), (3, "z", 1)],
        "doc_id int, term string, tf long",
    ).withColumn("g", F.lit("c"))
    nd = spark.createDataFrame([("c", 4)], "g string, n_docs long")
    w = {(r["doc_id"], r["term"]): r["weight"] for r in V.tfidf_topic(bow, nd, "doc_id", ["g"]).collect()}
    assert (0, "z") not in w
    assert round(w[(0, "x")], 6) == 0.970143 and round(w[(0, "y")], 6) == 0.242536


def test_smooth_idf_fixture(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (1, ["a"])], "doc_id int, toks array<string>")
    idf = {r["term"]: r["idf"] for r in V.smooth_idf(df, "doc_id", "toks", 2).collect()}
    assert abs(idf["a"] - 1.0) < 1e-12 and round(idf["b"], 6) == 1.405465


# F3 / F4 -----------------------------------------------------------------------------------------
def test_pooling_fixture(spark):
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vector array<double>")
    docs = spark.createDataFrame([(1, ["a", "b", "a", "zz"]), (2, ["zz"]), (3, [])], "doc_id int, toks array<string>")
    m = {r[0]: r[1] for r in EM.mean_pool(docs, "doc_id", "toks", vec, 2).select("doc_id", "embeds").collect()}
    assert [round(x, 6) for x in m[1]] == [0.666667, 0.333333] and m[2] == [0.0, 0.0] and m[3] == [0.0, 0.0]
    idf = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "term string, idf double")
    t = {r[0]: r[1] for r in EM.idf_pool(docs, "doc_id", "toks", vec, idf, 2).select("doc_id", "embeds").collect()}
    assert [round(x, 6) for x in t[1]] == [0.666667, 0.666667]


def test_subword_vectors(spark):
    vec = spark.createDataFrame([("phone", [1.0, 0.0]), ("phones", [0.0, 1.0])], "word string, vector array<double>")
    words = spark.createDataFrame([("phone",), ("phonex",), ("qqq",)], "word string")
    out = {r[0]: r[1] for r in EM.subword_vectors(vec, words, 2).collect()}
    assert out["phone"] == [1.0, 0.0] and out["qqq"] == [0.0, 0.0]
    assert out["phonex"][0] > 0 and out["phonex"][1] > 0


# E1-E6 -------------------------------------------------------------------------------------------
def _preds(spark):
    return spark.createDataFrame(list(zip([0, 0, 1, 1, 2, 2], [0, 1, 1, 1, 2, 0])), "label int, prediction int")


def test_confusion_and_report(spark):
    p = _preds(spark)
    ovr = {r["class"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in EV.confusion_ovr(p).collect()}
    assert ovr == {0: (3, 1, 1, 1), 1: (3, 1, 0, 2), 2: (4, 0, 1, 1)}
    cm = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion_matrix(p).collect()}
    assert [[cm[(i, j)] for j in range(3)] for i in range(3)] == [[1, 1, 0], [0, 2, 0], [1, 0, 1]]
    rep = {r["row"]: r for r in EV.class_report(p).collect()}
    assert [round(rep[c]["precision"], 6) for c in "012"] == [0.5, 0.666667, 1.0]
    assert [round(rep[c]["recall"], 6) for c in "012"] == [0.5, 1.0, 0.5]
    assert [round(rep[c]["f1"], 6) for c in "012"] == [0.5, 0.8, 0.666667]
    assert round(rep["accuracy"]["f1"], 6) == 0.666667
    assert round(rep["macro avg"]["f1"], 6) == 0.655556 and round(rep["weighted avg"]["f1"], 6) == 0.655556
    mm = EV.macro_metrics(p).first()
    assert round(mm["accuracy"], 6) == 0.666667 and round(mm["f1"], 6) == 0.655556


def test_never_predicted_class_precision_zero(spark):
    p = spark.createDataFrame([(0, 1), (1, 1)], "label int, prediction int")
    rep = {r["row"]: r for r in EV.class_report(p).collect()}
    assert rep["0"]["precision"] == 0.0 and rep["0"]["recall"] == 0.0


def test_cross_entropy_and_roc(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.2, 0.8]), (1, [0.6, 0.4])], "label int, probability array<double>")
    df = df.withColumn("prediction", EV.argmax(F.col("probability")))
    ce = EV.cross_entropy(df).first()
    assert abs(ce["loss"] - (-(math.log(0.9) + math.log(0.8) + math.log(0.4)) / 3)) < 1e-12
    assert abs(ce["accuracy"] - 2 / 3) < 1e-12
    pts = EV.roc_pr_points(df, bins=10).where(F.col("class") == 1).orderBy("threshold").collect()
    assert pts[0]["tpr"] == 1.0 and pts[0]["fpr"] == 1.0
    assert EV.one_hot(F.lit(2), 3) is not None


# G1 / G3 -----------------------------------------------------------------------------------------
def test_augment_factor_and_total(spark):
    rows = [(i, 2) for i in range(19161)] + [(100000 + i, 0) for i in range(1185)] + [(200000 + i, 1) for i in range(903)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    k = {r["label"]: r["k"] for r in AU.copies_per_sample(df, "label").collect()}
    assert k == {2: 0, 0: 15, 1: 20}
    assert 19161 + 1185 * 16 + 903 * 21 == 57084


def test_synonym_augment_rows_and_determinism(spark):
    docs = spark.createDataFrame(
        [(1, ["good", "phone"], 0), (2, ["bad"], 1), (3, ["nice", "screen"], 1), (4, [], 0)] + [(10 + i, ["ok"], 2) for i in range(6)],
        "doc_id long, toks array<string>, label int",
    )
    syn = spark.createDataFrame([("good", ["fine", "great"]), ("bad", ["poor"])], "word string, synonyms array<string>")
    out = AU.balance_by_augmentation(docs, "doc_id", "toks", "label", syn)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    # k: label0 n=2 -> 2, label1 n=2 -> 2, label2 n=6 -> 0
    assert counts == {0: 2 * 3, 1: 2 * 3, 2: 6}
    a = sorted(map(tuple, out.select("doc_id", "copy", F.array_join("toks", " ")).collect()))
    b = sorted(map(tuple, AU.balance_by_augmentation(docs, "doc_id", "toks", "label", syn).select("doc_id", "copy", F.array_join("toks", " ")).collect()))
    assert a == b
    lens = {(r[0], r[1]): r[2] for r in out.select("doc_id", "copy", F.size("toks")).collect()}
    assert lens[(1, 1)] == 2 and lens[(4, 2)] == 0


# C7 ----------------------------------------------------------------------------------------------
def test_umass_fixture_and_brute_force(spark):
    # N=4, D(a)=2, D(b)=4, D(a,b)=2 ; topic order (b, a): pair (a | b) = ln(.5 + 1e-12)
    docs = [{"a", "b"}, {"a", "b"}, {"b"}, {"b"}]
    dt = spark.createDataFrame([(i, t) for i, d in enumerate(docs) for t in d], "doc_id int, term string")
    top = spark.createDataFrame([(0, "b", 1), (0, "a", 2)], "topic int, term string, rank int")
    got = CO.umass(top, dt, 4, [], ["topic"]).first()["coherence"]
    assert abs(got - math.log(0.5 + 1e-12)) < 1e-12
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(30)]
    docs = [set(rng.sample(vocab, rng.randint(1, 8))) for _ in range(120)]
    topics = [rng.sample(vocab, 20), rng.sample(vocab, 7)]
    dt = spark.createDataFrame([(i, t) for i, d in enumerate(docs) for t in d], "doc_id int, term string")
    tp = spark.createDataFrame([(k, w, r + 1) for k, ws in enumerate(topics) for r, w in enumerate(ws)], "topic int, term string, rank int")
    per = {r["topic"]: r["coherence"] for r in CO.umass(tp, dt, len(docs), [], ["topic"]).collect()}
    model = sum(per.values()) / 2
    assert abs(model - CO.umass_reference(topics, docs)) < 1e-9


# C3 ----------------------------------------------------------------------------------------------
def test_gsdmm_recovers_planted_clusters(spark):
    rng = random.Random(0)
    rows = []
    for d in range(60):
        base = 0 if d < 30 else 10
        ids = sorted(set(rng.sample(range(base, base + 10), 5)))
        rows.append(("c", d, ids, [1] * len(ids), 0 if d < 30 else 1))
    df = spark.createDataFrame(rows, "g string, doc_id int, ids array<int>, cnts array<int>, truth int")
    assign, _ = GS.fit_gsdmm(df.drop("truth"), "g", {"c": 8}, {"c": 20}, 0.1, 0.1, 20, seed=3)
    j = assign.join(df.select("doc_id", "truth"), "doc_id")
    pure = j.groupBy("z").agg(F.countDistinct("truth").alias("k")).collect()
    assert all(r["k"] == 1 for r in pure)
    assert len(pure) <= 4


def test_ordered_rank_matches_sort(spark):
    rng = random.Random(4)
    rows = [(g, f"t{rng.randint(0, 400)}x{i}", rng.choice([20, 20, 20, 21, 25, 40, 99])) for i in range(2000) for g in ("a",) ] + \
        [("b", f"w{i}", rng.randint(1, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, term string, df long")
    got = {(r["g"], r["term"]): r["term_id"] for r in V.rank_terms(df, ["g"]).collect()}
    for g in ("a", "b"):
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1].encode()))
        assert [got[(g, r[1])] for r in ordered] == list(range(len(ordered)))


def _labelled_folder(spark, path):
    docs = [(i, f"dont stop the Great{i % 3} red fox, it's fine", "en", "web", 30) for i in range(30)] + [(30, None, "en", "web", 0), (31, "the", "en", "web", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(20)] + [(30, 1, 0), (31, 1, 0), (29, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_null_drop_cleans_a_text_once(spark, tmp_path):
    from __spark_entry__ import queries

    out = queries()["null_drop"](spark, _labelled_folder(spark, tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join(filter(") == 1 and "LeftOuter" not in plan
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(20)) and all(r["sentiment"] == 2 and r["clean"] for r in rows)


def test_trigram_merge_merges_bigrams_once(spark, tmp_path):
    from __spark_entry__ import queries

    out = queries()["trigram_merge"](spark, _labelled_folder(spark, tmp_path))
    assert any("trigram-bigrams" in f for f in out.inputFiles()) and not any("documents.parquet" in f for f in out.inputFiles())
    assert out.count() == 32
