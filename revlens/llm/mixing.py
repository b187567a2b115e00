"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents fall into cells (source, language, topic) that carry their token sums. Raking scales the cells
in turn so that the token shares by source, by language and by topic meet their targets; after the last
sweep each cell has a factor, and ``factor / largest factor`` is the probability with which each of its
documents is kept. The expected token shares of the sample are therefore the raked ones. Only cells that
hold tokens count for the largest factor; the others weigh nothing, whatever their probability.

By that rule the rarest cell decides how much of all others goes. With a ``rate`` the sample holds that
share of the tokens instead: the probability is ``min(1, c * factor)``, cells that reach 1 are kept whole
and ``c`` is raised until the others, still in the raked proportions, fill what is left.

Targets default to tempered shares, ``share ** alpha`` normalised, which lifts small sources, languages
and topics without emptying large ones. A topic is any column; ``form_topic`` derives one from a text's
form, for tables that have none.

Scale: documents are read twice (cell sums, then sampling) and shuffled once at most. The cell table
has one row per (source, language, topic) seen and stays distributed, nested by source behind one
``checkpoint()``; languages and topics are small vocabularies, whose factors the driver holds. Documents
meet their cell's probability by a broadcast join
while there are at most ``broadcast_cells`` cells, beyond that by a join that salts each cell over
``salt`` keys, so that a cell with a third of all rows is spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.registry import query, table
from revlens.session import checkpoint_dir

ALPHA, SWEEPS, SEED = 0.8, 8, "mix"
DIMENSIONS = ("source", "lang", "topic")

# --- fixed values: forms of a text, in order of precedence; lengths in characters ----------------
MARKS = ("###", "***", "$$$", "%%%", "&&&", "!! ", "===", "~~~")
LONG_CHARS, SHORT_CHARS = 8000, 600
SPACES = "[ \\t\\n\\x0B\\f\\r]+"
# -------------------------------------------------------------------------------------------------


def key(c: Column) -> Column:
    """A value's key: never null, and a null's differs from every value's."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def count_words(text: Column) -> Column:
    """White-space separated words; 0 for null or blank texts."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")
    return F.size(words).cast("long")


def form_topic(text: Column) -> Column:
    """A text's form: empty, table (has a bar), marked (has runs of marks), long, short or prose."""
    n = F.length(text)
    marked = reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in MARKS])
    return (
        F.when(text.isNull() | (n == 0), "empty")
        .when(F.contains(text, F.lit("|")), "table")
        .when(marked, "marked")
        .when(n >= LONG_CHARS, "long")
        .when(n < SHORT_CHARS, "short")
        .otherwise("prose")
    )


def tempered(tokens: dict[str, float], alpha: float) -> dict[str, float]:
    """Target shares: token sums to the power ``alpha``, normalised; values without tokens have none."""
    power = {k: v**alpha for k, v in tokens.items() if v > 0}
    return {k: v / sum(power.values()) for k, v in power.items()}


def rake(
    cells: DataFrame, source_targets: DataFrame | None, targets: dict[str, dict[str, float]], alpha: float, sweeps: int
) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``factor``, after ``sweeps`` rounds of raking.

    ``source_targets`` has columns source and share, ``targets`` shares by language and topic; what isn't
    given is tempered. A source that ``source_targets`` doesn't list (or lists with a null or 0) keeps the
    share it has, and the others divide the rest in proportion to their targets. A source without tokens has
    the mean factor; a language or topic without a target or without tokens keeps its factor.

    Cells are nested by source, so a source's factor is a sum inside its row; each round then takes two
    aggregations that return one number per language and one per topic to the driver.
    """
    nested = cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells"), F.sum("tokens").alias("sum"))
    if source_targets is None:
        power = F.pow("sum", F.lit(alpha))
        held = nested.where("sum > 0").agg(F.sum(power).alias("total"), F.sum("sum").alias("tokens")).first()
        nested = nested.withColumn("share", power / F.lit(held["total"] or 1.0))
    else:
        nested = nested.join(source_targets, "source", "left")
        listed = F.col("share") > 0
        held = nested.where("sum > 0").agg(
            F.sum("sum").alias("tokens"), F.sum(F.when(listed, F.col("sum"))).alias("known"), F.sum(F.when(listed, F.col("share"))).alias("total")
        ).first()
        if held["known"]:
            rest = F.col("share") / F.lit(held["total"] * held["tokens"] / held["known"])
            nested = nested.withColumn("share", F.when(listed, rest).otherwise(F.col("sum") / F.lit(held["tokens"])))
    mean = 1.0 / (held["tokens"] or 1.0)  # of the sources' factors, by tokens
    nested = nested.checkpoint()
    flat = nested.select("source", "sum", F.explode("cells").alias("c")).select("source", "sum", "c.*")
    tokens = {d: {r[0]: r[1] for r in flat.groupBy(d).agg(F.sum("tokens")).collect()} for d in ("lang", "topic")}
    goals = {d: targets.get(d) or tempered(tokens[d], alpha) for d in tokens}
    factor = {d: dict.fromkeys(tokens[d], 1.0) for d in tokens}

    def of(d: str, value: Column) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in factor[d].items() for x in kv]), value)

    def weighted() -> DataFrame:
        """Cells with ``own``, the factor of their source under the factors of the others as they were."""
        have = F.aggregate(
            "cells", F.lit(0.0), lambda s, c: s + c["tokens"] * of("lang", c["lang"]) * of("topic", c["topic"])
        )
        own = F.when((have > 0) & (F.col("share") > 0), F.col("share") / have).otherwise(F.lit(mean))
        rows = nested.select("source", "share", own.alias("own"), F.explode("cells").alias("c"))
        return rows.select("source", "own", "c.*")

    out = cells.withColumn("factor", F.lit(1.0))
    for _ in range(sweeps if tokens["lang"] else 0):
        now = weighted()  # its factors are literals of this round
        for d in ("lang", "topic"):
            load = F.col("own") * F.col("tokens") * of("lang", F.col("lang")) * of("topic", F.col("topic"))
            for value, have in now.groupBy(d).agg(F.sum(load)).collect():
                goal = goals[d].get(value, 0.0)
                if have > 0 and goal > 0:
                    factor[d][value] *= goal / have
        out = now.withColumn("factor", F.col("own") * of("lang", F.col("lang")) * of("topic", F.col("topic"))).drop("own")
    return out


def scale_to(raked: DataFrame, rate: float) -> float:
    """The ``c`` at which ``min(1, c * factor)`` keeps ``rate`` of the tokens; one aggregation per step.

    Each step holds the cells that the last one filled as whole and divides the rest among the others, so
    that ``c`` only grows, and ends when no more cells fill.
    """
    if rate == 1:
        return float("inf")
    held = raked.where("tokens > 0 AND factor > 0")
    c, filled = 0.0, -1
    while True:
        full = F.lit(c) * F.col("factor") >= 1
        now = held.agg(
            F.count(F.when(full, 1)).alias("filled"),
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0.0)).alias("whole"),
            F.sum(F.when(~full, F.col("tokens") * F.col("factor"))).alias("load"),
            F.sum("tokens").alias("tokens"),
        ).first()
        if now["filled"] == filled or not now["load"]:
            return c
        c, filled = max(c, (rate * now["tokens"] - now["whole"]) / now["load"]), now["filled"]


def chance(id_col: str, seed: str) -> Column:
    """A number in [0, 1) from the id: 52 bits of its md5."""
    bits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key(F.col(id_col)))), 1, 13)
    return F.conv(bits, 16, 10).cast("double") / float(1 << 52)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: Column | None = None,
    lang: Column | None = None,
    topic: Column | None = None,
    tokens: Column | None = None,
    source_targets: DataFrame | None = None,
    targets: dict[str, dict[str, float]] | None = None,
    alpha: float = ALPHA,
    sweeps: int = SWEEPS,
    seed: str = SEED,
    broadcast_cells: int = 100_000,
    salt: int = 64,
    rate: float | None = None,
) -> DataFrame:
    """``docs`` with mix_topic, mix_tokens, mix_probability and mix_kept.

    Dimensions default to the columns source and lang, ``form_topic`` and ``count_words`` of text.
    Targets go by value keys, see ``key``: ``source_targets`` is a table (source, share), ``targets`` may
    hold shares for lang and topic; what isn't given is tempered.

    ``rate`` (above 0, 1 at most) is the share of the tokens to keep, see the module; without one the cell
    with the largest factor is just kept whole. The nearer it is to 1, the more cells are kept whole and the
    nearer the shares stay to those of ``docs``.

    A null source, language or topic is a value of its own. Null and blank texts weigh nothing and are
    kept with their cell's probability. The draw depends on the id (null ids share one) and ``seed``
    alone, so repeated ids stand or fall together. Columns of ``docs`` that bear the names of the added
    ones are replaced. An empty table gives no rows.
    """
    if rate is not None and not 0 < rate <= 1:
        raise ValueError(f"rate must be above 0 and at most 1: {rate}")
    checkpoint_dir(docs.sparkSession)
    added = ["mix_topic", "mix_tokens", "mix_probability", "mix_kept"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    topic = form_topic(F.col("text")) if topic is None else topic
    dims = dict(zip(DIMENSIONS, (F.col("source") if source is None else source, F.col("lang") if lang is None else lang, topic), strict=True))
    facts = {"mix_topic": topic, "mix_tokens": count_words(F.col("text")) if tokens is None else tokens}
    keys = {f"_{d}": key(c) for d, c in dims.items()}

    seen = docs.select(*[c.alias(d) for d, c in zip(DIMENSIONS, keys.values(), strict=True)], facts["mix_tokens"].alias("n"))
    cells = seen.groupBy(*DIMENSIONS).agg(F.sum("n").cast("double").alias("tokens")).checkpoint()
    raked = rake(cells, source_targets, targets or {}, alpha, sweeps)
    top = raked.agg(F.max(F.when(F.col("tokens") > 0, F.col("factor"))).alias("top"), F.count(F.lit(1)).alias("cells")).first()
    scaled = F.col("factor") / F.lit(top["top"]) if rate is None else F.col("factor") * F.lit(scale_to(raked, rate))
    odd = F.least(F.lit(1.0), scaled) if top["top"] else F.lit(1.0)
    odds = raked.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], odd.alias("mix_probability"))
    rows = docs.select(*kept, *[c.alias(n) for n, c in (facts | keys).items()])
    if top["cells"] <= broadcast_cells:
        met = rows.join(F.broadcast(odds), list(keys))
    else:
        spread = odds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        met = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col, "mix_tokens"), F.lit(salt)).cast("int")).join(spread, [*keys, "_salt"]).drop("_salt")
    return met.drop(*keys).select(
        *kept, "mix_topic", "mix_tokens", "mix_probability", (chance(id_col, seed) < F.col("mix_probability")).alias("mix_kept")
    )


def mix_sql(alpha: float = ALPHA, sweeps: int = SWEEPS, seed: str = SEED) -> str:
    """DuckDB SQL for op8: the raking steps, one after the other, as window sums."""
    marked = " OR ".join(f"contains(text, '{m}')" for m in MARKS)
    topic = f"""CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty' WHEN contains(text, '|') THEN 'table' WHEN {marked} THEN 'marked'
      WHEN length(text) >= {LONG_CHARS} THEN 'long' WHEN length(text) < {SHORT_CHARS} THEN 'short' ELSE 'prose' END"""
    words = f"len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> ''))"
    steps = [
        f"""WITH d AS (SELECT doc_id, source, lang, {topic} AS topic, {words} AS tokens FROM documents),
k AS (SELECT *, coalesce('=' || source, '') AS ks, coalesce('=' || lang, '') AS kl, coalesce('=' || topic, '') AS kt FROM d),
c AS (SELECT ks, kl, kt, sum(tokens)::DOUBLE AS tokens, 1.0::DOUBLE AS f FROM k GROUP BY ALL)"""
    ]
    for v in ("ks", "kl", "kt"):
        steps.append(
            f"t_{v} AS (SELECT {v}, p / sum(p) OVER () AS share FROM (SELECT {v}, pow(sum(tokens), {alpha}::DOUBLE) AS p FROM c GROUP BY {v}) WHERE p > 0)"
        )
    last = "c"
    for i in range(sweeps):
        for v in ("ks", "kl", "kt"):
            have = f"sum(tokens * f) OVER (PARTITION BY {v})"
            # a source without tokens starts at the mean of the sources' factors, by tokens
            start = "1.0::DOUBLE / nullif((SELECT sum(tokens) FROM c), 0)" if (i, v) == (0, "ks") else "1.0::DOUBLE"
            scale = f"CASE WHEN {have} > 0 AND share > 0 THEN share / {have} ELSE {start} END"
            now = f"c_{i}_{v}"
            steps.append(f"{now} AS (SELECT {last}.ks, {last}.kl, {last}.kt, tokens, f * {scale} AS f FROM {last} LEFT JOIN t_{v} USING ({v}))")
            last = now
    return (
        ",\n".join(steps)
        + f""",
o AS (SELECT ks, kl, kt, coalesce(least(1.0::DOUBLE, f / max(CASE WHEN tokens > 0 THEN f END) OVER ()), 1.0::DOUBLE) AS p FROM {last})
SELECT doc_id, source, lang, topic, CAST(tokens AS BIGINT) AS n_tokens, round(p, 9) AS probability,
  CAST('0x' || substr(md5('{seed}:' || coalesce('=' || doc_id::VARCHAR, '')), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE < p AS kept
FROM k JOIN o USING (ks, kl, kt)"""
    )


@query("op8_mixing", mix_sql())
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "source",
        "lang",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_probability", 9).alias("probability"),
        F.col("mix_kept").alias("kept"),
    )
