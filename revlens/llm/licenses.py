"""License scans: normalised text against licence templates by the Dice coefficient of word bigrams.

A document is scanned in units: each line, each sentence of a line that has several, each paragraph of
several lines (paragraphs are parted by blank lines) and, where there are several paragraphs, the whole text. Units and templates are
normalised alike (ASCII lower case, everything but a-z and 0-9 parts words) and compared as bags of
word bigrams: ``dice = 2 * sum of min counts / (bigrams of unit + bigrams of template)``.

A dice of at least ``t`` needs ``t / (2 - t) <= unit size / template size <= (2 - t) / t``. Sizes are
word counts less one, so the bounds drop units that fit no template before any bigram is built, and
templates that don't fit a unit inside the join. It also needs ``t / (2 - t)`` of the template's bigrams to
be in the unit, so one at least of any ``size - ceil(t / (2 - t) * size) + 1`` of them is. Those with the
least common words are the template's keys: a unit meets a template by its key bigrams only, and a document
without such a word of any key leaves before it is cut into units.

Only DataFrame functions. The templates are a fixed table (some ten thousand bigrams), hence the broadcasts.
A unit meets a template once, by the first key bigram they share; the dice is computed in that row, and
only units that match are shuffled, so neither a frequent line nor a frequent bigram gathers anywhere.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.wordlists import spark_stop_words
from revlens.llm.licensetexts import TEXTS
from revlens.llm.registry import query, table

THRESHOLD = 0.8

# --- fixed values: names of public licences, usual notice wordings, and notice paragraphs ------
NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0"],
    "BSL-1.0": ["Boost Software License, version 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}
NOTICES = ["Released under {}", "Licensed under {}", "Distributed under {}", "This work is licensed under {}"]
PARAGRAPHS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}
WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
]
GNU = (
    "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} General Public "
    "License as published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version."
)
BODIES = [
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
     "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
     "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    *[("BSD-2-Clause", c) for c in CLAUSES],
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", WARRANTY.format("HOLDER")),
    ("BSD-2-Clause", WARRANTY.format("OWNER")),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
     "language governing permissions and limitations under the License."),
    ("AGPL-3.0", GNU.format("program", ":", "Affero", "3")),
    ("LGPL-2.1", GNU.format("library", ";", "Lesser", "2.1")),
    ("LGPL-3.0", GNU.format("library", ":", "Lesser", "3")),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
     "https://www.boost.org/LICENSE_1_0.txt)"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
     "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
     "is furnished to do so, all subject to the following:"),
    ("BSL-1.0", "The copyright notices in the Software and this entire statement, including the above license grant, this restriction "
     "and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works "
     "of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated "
     "by a source language processor."),
]
RIGHTS = ["All rights reserved.", "Copyright. All rights reserved.", "Copyright (c). All rights reserved.", "All rights reserved worldwide."]
SPDX = "SPDX-License-Identifier: {}"
# ---------------------------------------------------------------------------------------------


def templates() -> list[tuple[str, str]]:
    """(licence, text): every notice wording with every name, the notice paragraphs, SPDX and reserved-rights
    lines, and the paragraphs of licence texts. What several licences share bears the first one's name."""
    out = []
    for licence, names in NAMES.items():
        for name in names:
            article = "" if name.startswith("CC") else "the " if not name.startswith("Creative") else "a "
            out += [(licence, notice.format(article + name)) for notice in NOTICES]
    out += [(licence, text) for licence, texts in PARAGRAPHS.items() for text in texts]
    for licence in NAMES:
        kinds = ["", "-only", "-or-later"] if "GPL" in licence else [""]
        out += [(licence, SPDX.format(licence + kind)) for kind in kinds]
    out += [("LicenseRef-All-Rights-Reserved", text) for text in RIGHTS] + BODIES
    return out + [(licence, text) for licence, texts in TEXTS.items() for text in texts]


SENTENCE_END = "(?<=[.!?;])[ \\t]+(?=[^ \\t\\r])"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    kept = (c.lower() if c in UPPER else c if c in LOWER + "0123456789" else " " for c in text)
    return "".join(kept).split()


def template_bigrams(known: list[tuple[str, str]]) -> list[tuple[int, str, int, str, int]]:
    """(template number, licence, bigrams in all, bigram, its count); templates of one word have none."""
    rows = []
    for k, (licence, text) in enumerate(known):
        w = words_of(text)
        rows += [(k, licence, len(w) - 1, b, n) for b, n in Counter(f"{x} {y}" for x, y in zip(w, w[1:], strict=False)).items()]
    return rows


def needed(threshold: float) -> float:
    """The least share of a template's bigrams that a unit of ``threshold`` holds, and of a unit's in a template."""
    return threshold / (2 - threshold)


STOP_WORDS = frozenset(spark_stop_words("english"))


def commonness(word: str) -> tuple[bool, int]:
    """A guess at how common a word is in text of any kind: stop words first, then by shortness."""
    return word in STOP_WORDS, -len(word)


def marker(bigram: str) -> str:
    """The less common word of a bigram, the first of equal ones."""
    return min(bigram.split(), key=commonness)


def key_bigrams(known: list[tuple[str, str]], threshold: float) -> dict[int, list[str]]:
    """Bigrams of each template, one of which every unit that matches it holds.

    Any ``size - ceil(needed * size) + 1`` elements of the bag would do. Those with the least common marker
    are taken, and of these the ones whose marker most templates share, so that there are few markers.
    Repeats of a bigram stand together, so a prefix of the bag is a set of bigrams.
    """
    rows = template_bigrams(known)
    shared = Counter(marker(r[3]) for r in rows)
    bags: dict[int, list[str]] = {}
    for k, _, _, bigram, n in sorted(rows, key=lambda r: (r[0], commonness(marker(r[3])), -shared[marker(r[3])], r[3])):
        bags.setdefault(k, []).extend([bigram] * n)
    return {k: list(dict.fromkeys(bag[: len(bag) - math.ceil(needed(threshold) * len(bag) - 1e-9) + 1])) for k, bag in bags.items()}


def normalised_words(text: Column) -> Column:
    """Words of a text; an array of one empty string if there are none."""
    plain = F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " ")
    return F.split(F.trim(plain), " ")


def literal_rows(rows: list[tuple]) -> str:
    def lit(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The best template of every unit that has one with a dice of at least ``threshold``.

    Columns: doc_id, unit (line, sentence, paragraph or text), unit_no (from 0 among its kind in the document),
    license, template (its number in ``known``), dice, unit_text. Ties go to the smaller template number.

    Null and empty texts, and units of fewer than two words, have no match. Repeated rows are scanned
    once each and a null id stays null. Very long texts are scanned whole. An empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    known = templates() if known is None else known
    bigrams = template_bigrams(known)
    spark = docs.sparkSession
    keys = key_bigrams(known, threshold)
    sizes = {r[0]: r[2] for r in bigrams}
    key_rows = [(b, k, sizes[k], own) for k, own in keys.items() for b in own]
    index = spark.createDataFrame(key_rows, "key string, template int, template_size int, keys array<string>")
    bags = [(k, known[k][0], [r[3] for r in bigrams if r[0] == k], [(r[3], r[4]) for r in bigrams if r[0] == k and r[4] > 1]) for k in keys]
    bag = spark.createDataFrame(bags, "template int, license string, distinct array<string>, repeats array<struct<bigram:string,n:int>>")
    low, high = needed(threshold), 1 / needed(threshold)

    text = F.col("text")
    paragraphs = F.split(text, "\n[ \t\r]*\n")

    def units(kind: str, parts: Column) -> Column:
        return F.transform(
            parts,
            lambda p, i: F.struct(F.lit(kind).alias("unit"), i.cast("int").alias("unit_no"), p.alias("unit_text"), normalised_words(p).alias("words")),
        )

    lines = F.split(text, "\n")
    none = F.array().cast("array<string>")
    sentences = F.flatten(F.transform(lines, lambda x: F.when(x.rlike(SENTENCE_END), F.split(x, SENTENCE_END)).otherwise(none)))
    several = F.filter(paragraphs, lambda p: F.instr(p, "\n") > 0)
    numbers = F.filter(F.transform(paragraphs, lambda p, i: F.when(F.instr(p, "\n") > 0, i.cast("int"))), lambda i: i.isNotNull())
    several = F.transform(
        F.arrays_zip(numbers.alias("i"), several.alias("p")),
        lambda z: F.struct(F.lit("paragraph").alias("unit"), z["i"].alias("unit_no"), z["p"].alias("unit_text"), normalised_words(z["p"]).alias("words")),
    )
    whole = units("text", F.when(F.size(paragraphs) > 1, F.array(text)).otherwise(none))
    quoted = ", ".join(f"'{b}'" for b in sorted({r[0] for r in key_rows})) or "NULL"
    least, most = math.ceil(low * min(sizes.values(), default=1) - 1e-9), math.floor(high * max(sizes.values(), default=0) + 1e-9)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "row_no", F.monotonically_increasing_id()
    )
    markers = ", ".join(f"'{w}'" for w in sorted({marker(r[0]) for r in key_rows})) or "NULL"
    # each step reads the one before it once, and explode_outer adds no filter of its own: nothing runs twice
    held = (
        rows.withColumn("words", normalised_words(text))
        .where(F.expr(f"exists(words, w -> w IN ({markers}))"))
        .select("doc_id", "row_no", F.concat(units("line", lines), units("sentence", sentences), several, whole).alias("u"))
        .withColumn("u", F.expr(f"filter(u, x -> size(x.words) - 1 BETWEEN {least} AND {most})"))
        .withColumn(
            "u",
            F.expr(
                "transform(u, x -> named_struct('unit', x.unit, 'unit_no', x.unit_no, 'unit_text', x.unit_text, 'bigrams', "
                "zip_with(slice(x.words, 1, size(x.words) - 1), slice(x.words, 2, size(x.words)), (a, b) -> concat(a, ' ', b))))"
            ),
        )
        .withColumn(
            "u",
            F.expr(
                "transform(u, x -> named_struct('unit', x.unit, 'unit_no', x.unit_no, 'unit_text', x.unit_text, 'bigrams', x.bigrams, "
                f"'unit_size', size(x.bigrams), 'found', array_distinct(filter(x.bigrams, b -> b IN ({quoted})))))"
            ),
        )
        .select("doc_id", "row_no", F.explode_outer(F.expr("filter(u, x -> size(x.found) > 0)")).alias("u"))
        .where(F.col("u").isNotNull())
        .select("doc_id", "row_no", "u.*")
    )
    fits = F.col("unit_size").between(low * F.col("template_size"), high * F.col("template_size"))
    met = (
        held.withColumn("key", F.explode("found"))
        .join(F.broadcast(index), "key")
        .where(fits & (F.element_at(F.array_intersect("found", "keys"), 1) == F.col("key")))
        .join(F.broadcast(bag), "template")
    )
    more = F.aggregate(
        "repeats",
        F.lit(0),
        lambda acc, r: acc + F.greatest(F.least(r["n"], F.size(F.filter("bigrams", lambda b: b == r["bigram"]))) - 1, F.lit(0)),
    )
    dice = 2.0 * (F.size(F.array_intersect("distinct", "bigrams")) + more) / (F.col("unit_size") + F.col("template_size"))
    best = (
        met.withColumn("dice", dice)
        .where(F.col("dice") >= threshold)
        .groupBy("row_no", "doc_id", "unit", "unit_no", "unit_text")
        .agg(F.max_by(F.struct("license", "template", "dice"), F.struct("dice", -F.col("template"))).alias("m"))
    )
    return best.select("doc_id", "unit", "unit_no", "m.license", "m.template", "m.dice", "unit_text")


def scan_sql(known: list[tuple[str, str]], threshold: float) -> str:
    """DuckDB SQL for the rows of ``scan_licenses`` over ``documents``."""
    words = f"string_split(trim(regexp_replace(translate(unit_text, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ')"
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    end = "'([.!?;])[ \\t]+([^ \\t\\r])', '\\1' || chr(10) || '\\2', 'g'"
    # RE2 has no look-around: a sentence of one character is both an end and a start, so the marks go in twice
    parted = f"regexp_replace(regexp_replace(x, {end}), {end})"
    return f"""
WITH t(template, license, template_size, bigram, template_count) AS (VALUES {literal_rows(template_bigrams(known))}),
r AS (SELECT row_number() OVER () AS row_no, doc_id, text,
             regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS ps FROM documents WHERE text IS NOT NULL),
u AS (
  SELECT row_no, doc_id, 'line' AS unit, i - 1 AS unit_no, ls[i] AS unit_text
  FROM (SELECT row_no, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, string_split(text, chr(10)) AS ls FROM r))
  UNION ALL
  SELECT row_no, doc_id, 'sentence', i - 1, ss[i]
  FROM (SELECT row_no, doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM (SELECT row_no, doc_id, flatten(list_transform(
    list_filter(list_transform(string_split(text, chr(10)), lambda x: {parted}), lambda x: contains(x, chr(10))),
    lambda x: string_split(x, chr(10)))) AS ss FROM r))
  UNION ALL
  SELECT row_no, doc_id, 'paragraph', i - 1, ps[i]
  FROM (SELECT row_no, doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM r) WHERE contains(ps[i], chr(10))
  UNION ALL
  SELECT row_no, doc_id, 'text', 0, text FROM r WHERE len(ps) > 1),
w AS (SELECT *, {words} AS words FROM u),
b AS (SELECT row_no, doc_id, unit, unit_no, unit_text, len(words) - 1 AS unit_size, unnest(range(1, len(words))) AS i, words FROM w),
g AS (SELECT row_no, doc_id, unit, unit_no, unit_text, unit_size, words[i] || ' ' || words[i + 1] AS bigram, count(*) AS n
      FROM b GROUP BY ALL),
d AS (SELECT row_no, doc_id, unit, unit_no, unit_text, template, license,
             2.0::DOUBLE * sum(least(n, template_count)) / (unit_size + template_size) AS dice
      FROM g JOIN t USING (bigram)
      WHERE unit_size BETWEEN {low!r}::DOUBLE * template_size AND {high!r}::DOUBLE * template_size
      GROUP BY row_no, doc_id, unit, unit_no, unit_text, unit_size, template, license, template_size)
SELECT doc_id, unit, CAST(unit_no AS INTEGER) AS unit_no, license, CAST(template AS INTEGER) AS template, dice, unit_text
FROM d WHERE dice >= {threshold!r}::DOUBLE
QUALIFY row_number() OVER (PARTITION BY row_no, unit, unit_no ORDER BY dice DESC, template) = 1
"""


@query("op2_license_scan", scan_sql(templates(), THRESHOLD))
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
