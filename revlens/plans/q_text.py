"""Text-function queries.

The supplied corpus has no apostrophes, so the contraction and apostrophe queries append
one of a few fixed snippets to every document (chosen by key, in both engines).
"""

from __future__ import annotations


from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import tokens as K
from revlens.plans import sqlgen as G
from revlens.plans.q_profile import clean_sql
from revlens.plans.registry import query
from revlens.sources.tables import unlabelled_reviews

# fixed test snippets appended to documents (exercise T2 / T4 on the supplied corpus)
EXTRAS = [
    "I can't do it",
    "He'd've said 'no'",
    "ain't it WON'T y'all",
    "it 's do n't",
    "I ' m fine",
    "it' s fine",
    "dogs ' n cats",
    "bit's O'Clock",
    "'Cause they're 'quoted' (don't)!",
    "Y'ALL'RE here, can't've",
]

W = f"WITH {G.REVIEWS_CTE}"
EXTRA_SQL = "(text || ' ' || (" + G.sql_list(EXTRAS) + f")[((doc_id % {len(EXTRAS)}) + {len(EXTRAS)}) % {len(EXTRAS)} + 1])"
WX = W + f", rx AS (SELECT doc_id, {EXTRA_SQL} AS text FROM reviews)"


def with_extras(spark, sf):
    pick = F.element_at(F.array(*[F.lit(x) for x in EXTRAS]), (F.pmod(F.col("doc_id"), F.lit(len(EXTRAS))) + 1).cast("int"))
    return unlabelled_reviews(spark, sf).select("doc_id", F.concat(F.col("text"), F.lit(" "), pick).alias("text"))


# T1 --------------------------------------------------------------------------------------------
@query("fold_accents", W + f" SELECT doc_id, {G.fold_accents('text')} AS folded FROM reviews")
def q_fold_accents(spark, sf):
    return unlabelled_reviews(spark, sf).select("doc_id", T.fold_accents(F.col("text")).alias("folded"))


# T2 --------------------------------------------------------------------------------------------
@query("expand_contractions", WX + f" SELECT doc_id, {G.expand_contractions('text')} AS expanded FROM rx")
def q_expand_contractions(spark, sf):
    return with_extras(spark, sf).select("doc_id", T.expand_contractions(F.col("text")).alias("expanded"))


# T3 --------------------------------------------------------------------------------------------
@query(
    "strip_special",
    WX + f" SELECT doc_id, {G.strip_special('text')} AS stripped, {G.strip_special('text', True)} AS stripped_no_digits FROM rx",
)
def q_strip_special(spark, sf):
    return with_extras(spark, sf).select(
        "doc_id", T.strip_special(F.col("text")).alias("stripped"), T.strip_special(F.col("text"), True).alias("stripped_no_digits")
    )


# T4 --------------------------------------------------------------------------------------------
@query("apostrophe_spacing", WX + f" SELECT doc_id, {G.apostrophe_spacing('text')} AS fixed FROM rx")
def q_apostrophe_spacing(spark, sf):
    return with_extras(spark, sf).select("doc_id", T.apostrophe_spacing(F.col("text")).alias("fixed"))


# T6 / T8 / T9 ----------------------------------------------------------------------------------
@query(
    "tokenize",
    W + f", t AS (SELECT doc_id, {G.tokenize('text')} AS toks FROM reviews) "
    "SELECT doc_id, array_to_string(toks, ' ') AS tokens, CAST(len(toks) AS INTEGER) AS n_tokens FROM t",
)
def q_tokenize(spark, sf):
    t = unlabelled_reviews(spark, sf).select("doc_id", T.tokenize(F.col("text")).alias("toks"))
    return t.select("doc_id", T.join_tokens(F.col("toks")).alias("tokens"), T.doc_length(F.col("toks")).alias("n_tokens"))


# T7 --------------------------------------------------------------------------------------------
@query(
    "stopword_filter",
    W + f" SELECT doc_id, {G.join_tokens(G.stop_filter(G.tokenize('lower(text)')))} AS kept, "
    f"{G.join_tokens(G.stop_filter(G.tokenize('text'), lower_after=True))} AS kept_mixed FROM reviews",
)
def q_stopword_filter(spark, sf):
    r = unlabelled_reviews(spark, sf)
    return r.select(
        "doc_id",
        T.join_tokens(T.remove_stop_words(T.tokenize(F.lower("text")))).alias("kept"),
        T.join_tokens(T.remove_stop_words(T.tokenize(F.col("text")), is_lower_case=False)).alias("kept_mixed"),
    )


# T12 -------------------------------------------------------------------------------------------
def clean_ref_sql(expr: str) -> str:
    """Reference stage order: accents -> special -> apostrophes -> contractions -> lower."""
    x = G.fold_accents(expr)
    x = G.strip_special(x)
    x = G.apostrophe_spacing(x)
    x = G.expand_contractions(x)
    x = f"lower({x})"
    return G.join_tokens(G.stop_filter(G.tokenize(x)))


@query(
    "clean_text",
    WX + f" SELECT doc_id, coalesce({clean_sql('text')}, '') AS clean, {clean_ref_sql('text')} AS clean_ref FROM rx",
)
def q_clean_text(spark, sf):
    df = with_extras(spark, sf)
    return df.select(
        "doc_id",
        T.join_tokens(T.clean_text(F.col("text"))).alias("clean"),
        T.join_tokens(T.clean_text(F.col("text"), T.CleanOptions(order="reference"))).alias("clean_ref"),
    )


# token table shared by the lexicon queries: cleaned tokens of every document
CLEAN_TOKS_SQL = W + f", ct AS (SELECT doc_id, {G.stop_filter(G.tokenize('lower(' + G.strip_special(G.fold_accents('text')) + ')'))} AS toks FROM reviews)"


CORPUS_CLEAN = T.CleanOptions(contraction_expansion=False, correct_apos_whitespace=False, order="reference")


def clean_tokens(spark, sf):
    """Cleaned tokens of every document, persisted: cleaning is the costliest per-byte step and
    every corpus query reads its output several times (the cache manager matches the plan, so
    repeated calls share one materialisation; MEMORY_AND_DISK spills rather than recomputes)."""
    from pyspark import StorageLevel

    toks = unlabelled_reviews(spark, sf).select("doc_id", T.clean_text(F.col("text"), CORPUS_CLEAN).alias("toks"))
    return toks.persist(StorageLevel.MEMORY_AND_DISK)


# T10 -------------------------------------------------------------------------------------------
def lemma_table(toks):
    """Derived lexicon: plural-looking words map to the word without the final ``s``."""
    words = toks.select(F.explode("toks").alias("word")).distinct()
    return words.where((F.col("word").endswith("s")) & (F.length("word") > 3)).select(
        "word", F.expr("substring(word, 1, length(word) - 1)").alias("lemma")
    )


@query(
    "lemma_join",
    CLEAN_TOKS_SQL
    + ", lx AS (SELECT DISTINCT word, substr(word, 1, length(word) - 1) AS lemma FROM (SELECT unnest(toks) AS word FROM ct) "
    "WHERE suffix(word, 's') AND length(word) > 3) "
    ", u AS (SELECT doc_id, unnest(toks) AS w, generate_subscripts(toks, 1) AS pos FROM ct), "
    "m AS (SELECT u.doc_id, string_agg(coalesce(lx.lemma, u.w), ' ' ORDER BY u.pos) AS lemmas FROM u LEFT JOIN lx ON lx.word = u.w GROUP BY u.doc_id) "
    "SELECT ct.doc_id, coalesce(m.lemmas, '') AS lemmas FROM ct LEFT JOIN m ON ct.doc_id = m.doc_id",
)
def q_lemma_join(spark, sf):
    toks = clean_tokens(spark, sf)
    out = K.lemmatize(toks, "doc_id", "toks", lemma_table(toks))
    return out.select("doc_id", T.join_tokens(F.col("lemmas")).alias("lemmas"))


# T11 -------------------------------------------------------------------------------------------
def pos_table(toks):
    """Derived lexicon: the part of speech of a word of 3+ letters from its length mod 3."""
    words = toks.select(F.explode("toks").alias("word")).distinct().where(F.length("word") >= 3)
    pos = F.element_at(F.array(F.lit("NOUN"), F.lit("VERB"), F.lit("ADJ")), (F.length("word") % 3 + 1).cast("int"))
    return words.select("word", pos.alias("pos"))


@query(
    "pos_filter",
    CLEAN_TOKS_SQL
    + " SELECT doc_id, array_to_string(list_filter(toks, lambda w: length(w) >= 3 AND length(w) % 3 IN (0, 1)), ' ') AS kept FROM ct",
)
def q_pos_filter(spark, sf):
    toks = clean_tokens(spark, sf)
    out = K.filter_pos(toks, "doc_id", "toks", pos_table(toks), ("NOUN", "VERB", "PROPN"), out_col="kept")
    return out.select("doc_id", T.join_tokens(F.col("kept")).alias("kept"))


# T15 -------------------------------------------------------------------------------------------
MAX_LEN = 512  # the transformer encoders' maximum


def df_vocab(toks, min_df: int = 2):
    """Terms with document frequency >= min_df, ids 2.. by (df desc, term)."""
    dfc = toks.select("doc_id", F.explode(F.array_distinct("toks")).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    from revlens.operators.vocab import rank_terms

    ranked = rank_terms(dfc.where(F.col("df") >= min_df))
    return ranked.select("term", (F.col("term_id") + 2).alias("term_id"), "df")


@query(
    "encode_pad",
    CLEAN_TOKS_SQL
    + ", dfc AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(toks) AS term FROM ct) GROUP BY term), "
    "v AS (SELECT term, row_number() OVER (ORDER BY df DESC, term) + 1 AS term_id FROM dfc WHERE df >= 2), "
    f"u AS (SELECT doc_id, unnest(toks[1:{MAX_LEN}]) AS w, generate_subscripts(toks[1:{MAX_LEN}], 1) AS pos FROM ct), "
    "m AS (SELECT u.doc_id, list(CAST(coalesce(v.term_id, 1) AS INTEGER) ORDER BY u.pos) AS ids FROM u LEFT JOIN v ON v.term = u.w GROUP BY u.doc_id), "
    "e AS (SELECT ct.doc_id, coalesce(m.ids, []) AS ids FROM ct LEFT JOIN m ON ct.doc_id = m.doc_id) "
    f"SELECT doc_id, array_to_string(list_concat(ids, list_transform(range({MAX_LEN} - len(ids)), lambda x: 0)), ',') AS input_ids, "
    f"array_to_string(list_concat(list_transform(ids, lambda x: 1), list_transform(range({MAX_LEN} - len(ids)), lambda x: 0)), ',') AS attention_mask FROM e",
)
def q_encode_pad(spark, sf):
    toks = clean_tokens(spark, sf)
    out = K.encode_pad(toks, "doc_id", "toks", df_vocab(toks), MAX_LEN)
    return out.select(
        "doc_id", F.array_join("input_ids", ",").alias("input_ids"), F.array_join("attention_mask", ",").alias("attention_mask")
    )


# S4 --------------------------------------------------------------------------------------------
@query(
    "parse_list",
    CLEAN_TOKS_SQL + " SELECT doc_id, array_to_string(toks, '|') AS parsed, CAST(len(toks) AS INTEGER) AS n FROM ct",
)
def q_parse_list(spark, sf):
    stored = clean_tokens(spark, sf).select("doc_id", K.python_list_repr(F.col("toks")).alias("as_text"))
    parsed = stored.select("doc_id", K.parse_list(F.col("as_text")).alias("p"))
    return parsed.select("doc_id", F.array_join("p", "|").alias("parsed"), F.size("p").alias("n"))
