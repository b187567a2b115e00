"""Hand cases from FIXTURES.md and brute-force comparisons."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.functions.accents import fold_text_python
from revlens.functions.wordlists import CONTRACTION_MAP, extended_stop_words, spark_stop_words
from revlens.operators import profile as P
from revlens.operators import tokens as K


def _one(spark, fn, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_fold_accents_cases(spark):
    got = _one(spark, T.fold_accents, ["Café naïve ½ ß", "Ｆｕｌｌ ﬁ", "𝐁old 😀"])
    assert got == ["Cafe naive 12 ", "Full fi", "Bold "]


def test_fold_accents_matches_unicodedata(spark):
    rng = random.Random(7)
    pool = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c <= 0xDFFF] + ["𝐁", "🄁", "ﬃ", "㎏"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    got = _one(spark, T.fold_accents, texts)
    assert got == [fold_text_python(t) for t in texts]


def test_cleaning_computes_each_step_once(spark):
    """Text that is ASCII already is not folded, and no step of a text is computed again for its own guard."""
    df = spark.createDataFrame([("Caf\u00e9 [x]a",), ("plain a-b",), (None,), ("",)], "v string")
    folded = df.select(T.fold_accents(F.col("v")).alias("folded"))
    assert [r[0] for r in folded.collect()] == ["Cafe [x]a", "plain a-b", None, ""]
    plan = folded._jdf.queryExecution().analyzed().toString()
    assert plan.count("translate(") == 2 and "octet_length(" in plan
    assert [r[0] for r in df.select(T.tokenize(F.col("v"))).collect()] == [["Caf\u00e9", "[", "x", "]", "a"], ["plain", "a", "-", "b"], None, []]


def test_expand_contractions_cases(spark):
    cases = {
        "ain't": "is not", "Ain't": "Is not", "can't've": "cannot have", "'Cause": "Because",
        "He'd": "He would", "WON'T": "Will not", "he'd've": "he would have", "he'll've": "he will have",
        "I'LL go": "I will go", "y'all": "you all", "it's": "it is", "bit's": "bits",
        "no, they're 'quoted' (don't)!": "no, they are quoted (do not)!", "plain text": "plain text",
    }
    got = _one(spark, T.expand_contractions, list(cases))
    assert got == list(cases.values())


def test_contraction_map_shape():
    assert len(CONTRACTION_MAP) == 123
    assert len({k.lower() for k in CONTRACTION_MAP}) == 117


def test_strip_special_cases(spark):
    s = "a_b^c [x] `q` d'e f!1"
    assert _one(spark, T.strip_special, [s]) == ["a_b^c [x] `q` de f1"]
    assert _one(spark, lambda c: T.strip_special(c, True), [s]) == ["a_b^c [x] `q` de f"]


def test_strip_special_matches_python_regex(spark):
    rng = random.Random(3)
    alphabet = "abcXYZ019 _^[]`\\'!?.,;:-\t\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(200)]
    got = _one(spark, T.strip_special, texts)
    assert got == [re.sub(r"[^a-zA-z0-9\s]", "", t) for t in texts]


def test_apostrophe_spacing_cases(spark):
    cases = {"do n't": "don't", "it 's": "it's", "I ' m": "I'm", "it' s fine": "it's fine", "dogs ' n cats": "dogs'n cats"}
    assert _one(spark, T.apostrophe_spacing, list(cases)) == list(cases.values())


def test_apostrophe_spacing_matches_python(spark):
    rng = random.Random(11)
    alphabet = "ab Z'  '"
    texts = ["".join(rng.choice(alphabet) for _ in range(25)) for _ in range(300)]
    lead, trail = T.APOS_LEADING, T.APOS_TRAILING
    expect = [re.sub(trail, "", re.sub(lead, "", t)) for t in texts]
    assert _one(spark, T.apostrophe_spacing, texts) == expect


def test_tokenize_and_stop_words(spark):
    got = _one(spark, lambda c: F.array_join(T.tokenize(c), "|"), ["Hello,world! (a)b-c. x", "  "])
    assert got == ["Hello|,|world|!|(|a|)|b|-|c|.|x", ""]
    toks = spark.createDataFrame([(["the", "good", "the", "good", "!", "", "()"],)], "t array<string>")
    assert toks.select(T.remove_stop_words(F.col("t"))).first()[0] == ["good", "good"]
    mixed = spark.createDataFrame([(["The", "Good", "the"],)], "t array<string>")
    # mixed mode: stop words matched as written, survivors lower-cased
    assert mixed.select(T.remove_stop_words(F.col("t"), is_lower_case=False)).first()[0] == ["the", "good"]


def test_stop_lists():
    assert len(spark_stop_words()) == 181
    ext = extended_stop_words()
    assert "b" in ext and "z" in ext and "a" in spark_stop_words()


def test_clean_text_reference_order_never_expands(spark):
    t = "I can't do it"
    keep = dict(lemma_and_remove_stop_words=False)
    ours = _one(spark, lambda c: F.array_join(T.clean_text(c, T.CleanOptions(**keep)), " "), [t])
    ref = _one(spark, lambda c: F.array_join(T.clean_text(c, T.CleanOptions(order="reference", **keep)), " "), [t])
    assert ours == ["i cannot do it"]
    assert ref == ["i cant do it"]


def test_clean_text_string_mode_empty_to_null(spark):
    got = _one(spark, lambda c: T.clean_text(c, T.CleanOptions(tokenize=False)), ["!!!", "Great phone"])
    assert got == [None, "great phone"]


def test_curly_quotes_kept_by_default(spark):
    got = _one(spark, lambda c: F.array_join(T.clean_text(c, T.CleanOptions(lemma_and_remove_stop_words=False)), " "), ["don’t"])
    assert got == ["do not"]


def test_clean_text_plan_has_no_python(spark):
    df = spark.createDataFrame([("x",)], "text string").select(T.clean_text(F.col("text")).alias("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_label_map_unmapped_null_and_drop(spark):
    df = spark.createDataFrame([(r,) for r in [1, 2, 3, 4, 5, None, 9]], "rating int")
    out = P.recode_labels(df, {1: 0, 2: 0, 3: 1, 4: 2, 5: 2}, "rating", "labels")
    assert [r["labels"] for r in out.collect()] == [0, 0, 1, 2, 2, None, None]
    assert P.drop_incomplete(out).count() == 5


def test_parse_list(spark):
    df = spark.createDataFrame([("['a', \"don't\", 'b_c']",), ("[]",)], "s string")
    got = [r[0] for r in df.select(K.parse_list(F.col("s"))).collect()]
    assert got == [["a", "don't", "b_c"], []]


def test_lemma_and_pos_join_keep_order(spark):
    docs = spark.createDataFrame([(1, ["dogs", "run", "cats", "dogs"]), (2, [])], "doc_id int, toks array<string>")
    lem = spark.createDataFrame([("dogs", "dog"), ("cats", "cat")], "word string, lemma string")
    out = {r[0]: r[1] for r in K.lemmatize(docs, "doc_id", "toks", lem).select("doc_id", "lemmas").collect()}
    assert out == {1: ["dog", "run", "cat", "dog"], 2: []}
    pos = spark.createDataFrame([("dogs", "NOUN"), ("run", "VERB"), ("cats", "ADJ")], "word string, pos string")
    out = {r[0]: r[1] for r in K.filter_pos(docs, "doc_id", "toks", pos).select("doc_id", "pos_tokens").collect()}
    assert out == {1: ["dogs", "run", "dogs"], 2: []}


def test_encode_pad(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "zz"]), (2, ["a"] * 6)], "doc_id int, toks array<string>")
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "term string, term_id int")
    out = {r[0]: (r[1], r[2]) for r in K.encode_pad(docs, "doc_id", "toks", vocab, 4).select("doc_id", "input_ids", "attention_mask").collect()}
    assert out[1] == ([2, 3, 1, 0], [1, 1, 1, 0])
    assert out[2] == ([2, 2, 2, 2], [1, 1, 1, 1])


def test_unicode_fold_is_per_character():
    s = "Ça va? Ñandú ½"
    assert fold_text_python(s) == "".join(fold_text_python(c) for c in s)
    assert unicodedata.normalize("NFKD", "é") == "é"


def test_strip_special_ascii_translate_equals_regex(spark):
    rng = random.Random(21)
    texts = ["".join(chr(rng.randint(0, 127)) for _ in range(40)) for _ in range(300)]
    for digits in (False, True):
        a = _one(spark, lambda c: T.strip_special(c, digits), texts)
        b = _one(spark, lambda c: T.strip_special(c, digits, ascii_only=True), texts)
        assert a == b


def test_explode_rows_equals_explode(spark):
    from revlens.functions.arrays import explode_rows

    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None), (4, ["c"])], "k int, t array<string>")
    plain = sorted(tuple(r) for r in df.select("k", F.posexplode("t").alias("p", "w")).collect())
    ours = sorted(tuple(r) for r in explode_rows(df, ["k"], "t", "w", pos="p").select("k", "p", "w").collect())
    assert plain == ours
    # the cleaning expression is evaluated once: no inferred size() filter on the generator input
    toks = spark.createDataFrame([("a b",)], "text string").select(T.clean_text(F.col("text")).alias("tokens"))
    plan = explode_rows(toks, [], "tokens", "w")._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in plan


def test_parse_list_reads_repr(spark):
    lists = [["a\xa0b"], ["a", None], ["don't", 'say "x"'], [], ["back\\slash", "it's \"both\""]]
    df = spark.createDataFrame([(repr(x),) for x in lists], "s string")
    assert [r[0] for r in df.select(K.parse_list(F.col("s"))).collect()] == lists


def test_stop_list_equals_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(spark_stop_words()) == list(StopWordsRemover.loadDefaultStopWords("english"))
