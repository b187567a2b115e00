from revlens.llm.language import fit, identify, op4_language_id, predict
from tests.conftest import SF001


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op4_language_id(spark, SF001).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_foreign_text_is_rejected(spark, make_docs):
    learn = spark.read.parquet(f"{SF001}/documents.parquet")
    model = fit(learn)
    texts = [(1, "Это совсем другой язык, которого никто не учил, и букв таких в корпусе нет. " * 5), (2, "xqzw kvjq wqxz zzkq " * 40), (3, "1 2 3 !"), (4, None)]
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in predict(make_docs(texts), model).collect()}
    assert got[3] == ("und", True) and got[4] == ("und", True)
    assert got[1][1] and got[2][1] and got[1][0] in ("en", "fr", "de", "es")


def test_nasty_rows_and_clashing_names(nasty, nasty_rows):
    out = identify(nasty)
    assert sorted(out.columns) == sorted([*nasty.columns, "rejected"])
    rows = out.collect()
    assert len(rows) == len(nasty_rows)
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "fr", "de")


def test_nothing_to_learn(empty, nasty):
    assert identify(empty).count() == 0
    assert {r.lang_pred for r in predict(nasty, None).collect()} == {"und"}


def test_sample_is_bounded(spark, make_docs):
    from tests.llm.conftest import prose

    docs = make_docs([(i, prose(i % 5, 30)) for i in range(3000)])
    model = fit(docs, fit_rows=200)
    assert set(model.languages) == {"en"} and len(model.centroids) <= 4


def test_numerals_are_no_letters(spark, make_docs):
    model = fit(spark.read.parquet(f"{SF001}/documents.parquet"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(make_docs([(1, "²½"), (2, "①"), (3, "Ⅷ"), (4, "٣ 12_3"), (5, "ª")]), model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[5][0] != "und"


def plain_vectors(texts):
    """Bucket counts of character 1- to 3-grams by loops; the hashes are those of the module."""
    import numpy as np

    from revlens.llm.language import DIMS
    from revlens.llm.textcodes import mix

    out = np.zeros((len(texts), DIMS))
    for row, text in enumerate(texts):
        word = "".join(c if c.isalpha() else " " for c in text.lower())
        flat = " " + " ".join(word.split()) + " "
        for n in (1, 2, 3):
            for i in range(len(flat) - n + 1):
                gram = flat[i : i + n]
                if gram == " ":
                    continue
                h = n
                for c in gram:
                    h = (h * 0x100000001B3 + ord(c)) % 2**64
                out[row, int(mix(np.array([h], np.uint64))[0] >> np.uint64(52))] += 1
    return np.sqrt(out)


def test_prediction_against_brute_force(spark, make_docs):
    """Every text compared with every centroid by loops; the texts' vectors counted gram by gram."""
    import numpy as np

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = fit(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text and len(r.text) < 3000][:40]
    got = {r.doc_id: r.lang_pred for r in predict(make_docs(rows), model).collect()}
    v = plain_vectors([t for _, t in rows]) * np.asarray(model.idf)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for (i, _), x in zip(rows, v, strict=True):
        sims = [sum(a * b for a, b in zip(x, c)) for c in np.asarray(model.centroids, float)]
        best = max(sims)
        assert got[i] in {lang for lang, sim in zip(model.languages, sims) if sim > best - 1e-5}
    assert len({got[i] for i, _ in rows}) > 2
