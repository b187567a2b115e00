"""Text cleaning and tokenising as Catalyst expressions.

Every builder takes and returns a ``Column`` so a whole cleaning pipeline is one
projection inside whole-stage code generation: no Python runs per row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.accents import fold_tables
from revlens.functions.wordlists import (
    PUNCTUATION,
    TOKEN_PUNCT,
    lower_contractions,
    spark_stop_words,
)

# --- fixed values: patterns ------------------------------------------------------------
# Special characters: note ``A-z`` which also keeps [ \ ] ^ _ ` (behaviour kept on purpose).
SPECIAL_PATTERN = r"[^a-zA-z0-9\s]"
SPECIAL_PATTERN_NO_DIGITS = r"[^a-zA-z\s]"
# Whitespace before a word that carries an apostrophe, and after ``letter'``.
APOS_LEADING = r"(?<=[a-zA-Z])\s+(?=[a-z]*'\s*[a-z])"
APOS_TRAILING = r"(?<=[a-zA-Z]')\s+(?=[a-zA-Z])"
# Segments: runs of letters/apostrophes and runs of anything else.
SEGMENT_PATTERN = r"([A-Za-z']+|[^A-Za-z']+)"
# ---------------------------------------------------------------------------------------

_TOKEN_PUNCT_CLASS = "[" + "".join("\\" + c for c in TOKEN_PUNCT) + "]"
_PUNCT_ONLY = "^[" + "".join("\\" + c for c in PUNCTUATION) + "]+$"


def _regex_class(chars) -> str:
    return "[" + "".join("\\" + c if c in "\\[]^-&" else c for c in chars) + "]"


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it: below an array lambda
    Spark evaluates the tree as written, without sharing what occurs twice."""
    return F.transform(F.array(value), body)[0]


# T1 ---------------------------------------------------------------------------------------
def fold_accents(text: Column) -> Column:
    """NFKD fold keeping ASCII only (``Café`` -> ``Cafe``, ``½`` -> ``12``, ``ß`` -> '').

    Text with as many bytes as characters is ASCII and stays as it is."""
    src, dst, multi = fold_tables()
    lookup = F.create_map(*[F.lit(x) for kv in sorted(multi.items()) for x in kv])

    def fold(one: Column) -> Column:
        # guard: deleting the multi-letter characters shortens the string (hash lookups only;
        # a regex class over hundreds of literal characters is tested member by member)
        has_multi = F.length(F.translate(one, "".join(sorted(multi)), "")) < F.length(one)
        pieces = F.regexp_extract_all(one, F.lit(r"(?s)[\x00-\x7F]+|."), 0)
        expanded = F.array_join(F.transform(pieces, lambda c: F.coalesce(F.element_at(lookup, c), c)), "")
        return F.regexp_replace(F.when(has_multi, expanded).otherwise(one), r"[^\x00-\x7F]", "")

    return _once(text, lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(_once(F.translate(t, src, dst), fold)))


def straighten_quotes(text: Column) -> Column:
    """Curly single quotes to ``'`` so contractions survive folding (quirk 16)."""
    return F.translate(text, "’‘", "''")


# T2 ---------------------------------------------------------------------------------------
def _contraction_lookup() -> Column:
    table = lower_contractions()
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def expand_contractions(text: Column, mapping: dict[str, str] | None = None) -> Column:
    """Whole-word, case-insensitive contraction expansion, then every ``'`` removed.

    The case of the first letter is carried over (``WON'T`` -> ``Will not``). Rows without an
    apostrophe skip the segment pass.
    """
    lookup = (
        _contraction_lookup()
        if mapping is None
        else F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k.lower(), v)])
    )

    def expand(seg: Column) -> Column:
        hit = F.element_at(lookup, F.lower(seg))
        first = F.regexp_extract(seg, "[A-Za-z]", 0)
        cased = F.when(
            (first != "") & (first == F.upper(first)),
            F.concat(F.upper(F.substring(hit, 1, 1)), F.substring(hit, 2, 1 << 30)),
        ).otherwise(hit)
        return F.when(F.instr(seg, "'") > 0, F.coalesce(cased, seg)).otherwise(seg)

    segs = F.regexp_extract_all(text, F.lit(SEGMENT_PATTERN), 1)
    joined = F.array_join(F.transform(segs, expand), "")
    return F.when(F.instr(text, "'") > 0, F.translate(joined, "'", "")).otherwise(text)


# T3 ---------------------------------------------------------------------------------------
def strip_special(text: Column, remove_digits: bool = False, ascii_only: bool = False) -> Column:
    """Remove characters outside ``[a-zA-z0-9]`` and whitespace (digits too with ``remove_digits``).

    ``ascii_only=True`` is for text already folded to ASCII: the same deletion is then a
    ``translate`` over the finite set of ASCII characters the pattern rejects (hash lookups
    instead of a regex scan)."""
    pattern = SPECIAL_PATTERN_NO_DIGITS if remove_digits else SPECIAL_PATTERN
    if ascii_only:
        rx = re.compile(pattern.replace("\\s", "\t\n\x0b\f\r "))
        drop = "".join(chr(c) for c in range(128) if rx.fullmatch(chr(c)))
        return F.translate(text, drop, "")
    return F.regexp_replace(text, pattern, "")


# T4 ---------------------------------------------------------------------------------------
def apostrophe_spacing(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, APOS_LEADING, ""), APOS_TRAILING, "")


# T6 ---------------------------------------------------------------------------------------
def tokenize(text: Column) -> Column:
    """Whitespace split after spacing off ``: ; ( ) [ ] + . , ! ? \\ -`` that touch a letter."""
    p = _TOKEN_PUNCT_CLASS

    def space(t: Column) -> Column:
        # one pass: a space at every letter|punct and punct|letter boundary; a plain scan tells if there can be one
        return F.when(t.rlike(p), F.regexp_replace(t, f"(?<=[A-Za-z])(?={p})|(?<={p})(?=[A-Za-z])", " ")).otherwise(t)

    spaced = _once(text, space)
    return F.filter(F.split(spaced, r"\s+"), lambda t: t != "")


# T7 ---------------------------------------------------------------------------------------
def is_punct_token(tok: Column) -> Column:
    return tok.rlike(_PUNCT_ONLY)


def remove_stop_words(tokens: Column, stop_words=None, is_lower_case: bool = True) -> Column:
    """Drop stop words, empty and punctuation-only tokens; duplicates and order are kept.

    ``is_lower_case=False`` matches stop words as written and lower-cases the survivors.
    ``isin`` over a literal list becomes a hash-set lookup (InSet) inside the lambda.
    """
    stops = list(spark_stop_words("english") if stop_words is None else stop_words)

    def keep(t: Column) -> Column:
        return (t != "") & ~t.isin(stops) & ~is_punct_token(t)

    kept = F.filter(tokens, keep)
    return kept if is_lower_case else F.transform(kept, F.lower)


# T8 / T9 ----------------------------------------------------------------------------------
def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def doc_length(tokens: Column) -> Column:
    return F.size(tokens)


# T12 --------------------------------------------------------------------------------------
@dataclass(frozen=True)
class CleanOptions:
    """Switches of the cleaning pipeline.

    ``order="default"``: quotes -> accents -> contractions -> apostrophes -> special -> lower
    -> tokens. ``order="reference"``: accents -> special -> apostrophes -> contractions ->
    lower -> tokens (contractions then never fire because special-char removal drops ``'``).
    Contractions go before apostrophe spacing because the spacing rule removes the space
    before *any* word holding an apostrophe (``I can't`` would become ``Ican't``).
    """

    remove_accented_char: bool = True
    contraction_expansion: bool = True
    normalize: bool = True
    correct_apos_whitespace: bool = True
    remove_special_char: bool = True
    lemma_and_remove_stop_words: bool = True
    tokenize: bool = True
    remove_digits: bool = False
    order: str = "default"
    stop_words: tuple | None = field(default=None)


def clean_text(text: Column, opts: CleanOptions = CleanOptions()) -> Column:
    """The full pipeline as one expression. Returns ``array<string>`` when ``opts.tokenize``
    else ``string``; an empty string result becomes null (callers drop nulls, P7/P8)."""
    t = text
    if opts.order == "reference":
        steps = ["accents", "special", "apos", "contractions", "lower"]
    else:
        t = straighten_quotes(t)
        steps = ["accents", "contractions", "apos", "special", "lower"]
    for s in steps:
        if s == "accents" and opts.remove_accented_char:
            t = fold_accents(t)
        elif s == "special" and opts.remove_special_char:
            t = strip_special(t, opts.remove_digits, ascii_only=opts.remove_accented_char)
        elif s == "apos" and opts.correct_apos_whitespace:
            t = apostrophe_spacing(t)
        elif s == "contractions" and opts.contraction_expansion:
            t = expand_contractions(t)
        elif s == "lower" and opts.normalize:
            t = F.lower(t)
    if opts.lemma_and_remove_stop_words:
        toks = remove_stop_words(tokenize(t), opts.stop_words, is_lower_case=opts.normalize)
        if opts.tokenize:
            return toks
        return F.nullif(join_tokens(toks), F.lit(""))
    if opts.tokenize:
        return tokenize(t)
    return F.nullif(t, F.lit(""))


def quick_tokens(text: Column, stop_words) -> Column:
    """Quick profile pipeline (T13): tokenise, lower, drop the extended stop list and
    punctuation tokens."""
    toks = F.transform(tokenize(text), F.lower)
    return remove_stop_words(toks, stop_words, is_lower_case=True)


def regex_escape_literal(s: str) -> str:
    return re.escape(s)
