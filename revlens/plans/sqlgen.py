"""DuckDB SQL fragments mirroring the Spark expressions, for the oracle queries."""

from __future__ import annotations

from revlens.functions.text import SPECIAL_PATTERN, SPECIAL_PATTERN_NO_DIGITS
from revlens.functions.wordlists import PUNCTUATION, TOKEN_PUNCT, extended_stop_words, lower_contractions, spark_stop_words


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


TOKEN_PUNCT_CLASS = "[" + "".join("\\" + c for c in TOKEN_PUNCT) + "]"
PUNCT_CLASS = "[" + "".join("\\" + c for c in PUNCTUATION) + "]"

REVIEWS_CTE = """reviews AS (
  SELECT d.doc_id, d.text, d.lang AS category, d.source AS brand, d.n_chars,
         CAST(1 + ((d.doc_id % 5) + 5) % 5 AS INTEGER) AS rating,
         CAST(CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 0 THEN 1
                   WHEN l.quality IS NOT NULL AND l.toxic IS NOT NULL THEN 2 END AS INTEGER) AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def tokenize(expr: str) -> str:
    p = TOKEN_PUNCT_CLASS
    spaced = f"regexp_replace(regexp_replace({expr}, {q('([A-Za-z])(' + p + ')')}, {q(chr(92) + '1 ' + chr(92) + '2')}, 'g'), {q('(' + p + ')([A-Za-z])')}, {q(chr(92) + '1 ' + chr(92) + '2')}, 'g')"
    return f"list_filter(regexp_split_to_array({spaced}, '[[:space:]]+'), lambda t: t <> '')"


def stop_filter(list_expr: str, stops=None, lower_after: bool = False) -> str:
    stops = list(spark_stop_words("english") if stops is None else stops)
    kept = (
        f"list_filter({list_expr}, lambda t: t <> '' AND NOT list_contains({sql_list(stops)}, t) "
        f"AND NOT regexp_full_match(t, {q(PUNCT_CLASS + '+')}))"
    )
    return f"list_transform({kept}, lambda t: lower(t))" if lower_after else kept


def quick_tokens(expr: str) -> str:
    return stop_filter(f"list_transform({tokenize(expr)}, lambda t: lower(t))", extended_stop_words())


def fold_accents(expr: str) -> str:
    """Agrees with NFKD + ASCII for accented letters; compatibility characters (e.g. ``½``)
    are folded by the Spark side only, so fixtures with them are tested in pytest."""
    return f"regexp_replace(strip_accents({expr}), '[^\\x00-\\x7F]', '', 'g')"


def strip_special(expr: str, remove_digits: bool = False) -> str:
    # RE2's \s lacks \v; [:space:] is exactly Java's \s
    pat = (SPECIAL_PATTERN_NO_DIGITS if remove_digits else SPECIAL_PATTERN).replace("\\s", "[:space:]")
    return f"regexp_replace({expr}, {q(pat)}, '', 'g')"


def apostrophe_spacing(expr: str) -> str:
    """RE2 has no look-arounds, so the text is cut into whitespace / non-whitespace runs and
    a whitespace run is dropped when its neighbours satisfy the rule (matching on the
    original string, as a regex substitution does)."""
    ap = "''"  # an apostrophe inside a SQL string literal

    def nb(k: str) -> str:
        return f"coalesce(l[i {k}], '')"

    lead_ok = (
        f"(regexp_matches({nb('- 1')}, '[a-zA-Z]$') AND ("
        f"regexp_matches({nb('+ 1')}, '^[a-z]*{ap}[a-z]') OR "
        f"(regexp_full_match({nb('+ 1')}, '[a-z]*{ap}') AND regexp_matches({nb('+ 3')}, '^[a-z]'))))"
    )
    trail_ok = f"(regexp_matches({nb('- 1')}, '[a-zA-Z]{ap}$') AND regexp_matches({nb('+ 1')}, '^[a-zA-Z]'))"

    def apply(x: str, cond: str) -> str:
        runs = f"regexp_extract_all({x}, '[[:space:]]+|[^[:space:]]+')"
        body = f"CASE WHEN regexp_full_match(w, '[[:space:]]+') AND {cond} THEN '' ELSE w END"
        return f"(SELECT array_to_string(list_transform(l, lambda w, i: {body}), '') FROM (SELECT {runs} AS l))"

    return apply(apply(expr, lead_ok), trail_ok)


def expand_contractions(expr: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in lower_contractions().items())
    hit = f"(CASE lower(s) {cases} END)"
    first = "regexp_extract(s, '[A-Za-z]', 0)"
    cased = f"(CASE WHEN {first} <> '' AND {first} = upper({first}) THEN upper(substr({hit}, 1, 1)) || substr({hit}, 2) ELSE {hit} END)"
    seg = f"list_transform(regexp_extract_all({expr}, {q(chr(40) + '[A-Za-z' + chr(39) + ']+|[^A-Za-z' + chr(39) + ']+' + chr(41))}), lambda s: CASE WHEN contains(s, '''') THEN coalesce({cased}, s) ELSE s END)"
    return f"(CASE WHEN contains({expr}, '''') THEN replace(array_to_string({seg}, ''), '''', '') ELSE {expr} END)"


def join_tokens(list_expr: str) -> str:
    return f"array_to_string({list_expr}, ' ')"
