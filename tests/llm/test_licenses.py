import math
import random
import re
from collections import Counter

import duckdb
import pytest

from revlens.llm.licenses import THRESHOLD, key_bigrams, scan_licenses, scan_sql, templates, words_of


def dice(a, b):
    a, b = (Counter(zip(w, w[1:])) for w in (words_of(a), words_of(b)))
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))


TEXTS = [
    (1, "Hello there.\nReleased under the MIT License.\nBye."),
    (2, "released   under the mit-license!"),
    (3, "This work is licensed under the GNU General Public License, version 2."),
    (4, "Nothing about rights in this line of prose at all."),
    (5, "One\n\nPermission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby "
        "granted, provided that the above copyright notice\nand this permission notice appear in all copies.\n\nEnd"),
    (6, "Licensed under CC BY-NC 4.0.\n" * 3),
    (7, "the license the license the license the license"),
    (8, "A tool for many things we do. Released under the MIT License. Have fun! x ! y. Licensed under the ISC License;  bye\r\nAll rights reserved. "),
    (9, "Some words first. " + templates()[-1][1].replace(". ", ".  ") + "\n\n" + templates()[120][1]),
    (10, "\n\n".join(t for _, t in templates()[150:190])),
    (11, "the the the the the the. rights reserved all rights reserved all rights"),
]


def test_against_brute_force(make_docs):
    known = templates()
    got = {(r.doc_id, r.unit, r.unit_no): (r.license, r.template, round(r.dice, 9)) for r in scan_licenses(make_docs(TEXTS)).collect()}
    want = {}
    for i, text in TEXTS:
        ps = re.split(r"\n[ \t\r]*\n", text)
        units = [("line", k, u) for k, u in enumerate(text.split("\n"))]
        parted = [re.split(r"(?<=[.!?;])[ \t]+(?=[^ \t\r])", x) for x in text.split("\n")]
        units += [("sentence", k, u) for k, u in enumerate(u for p in parted if len(p) > 1 for u in p)]
        units += [("paragraph", k, u) for k, u in enumerate(ps) if "\n" in u] + ([("text", 0, text)] if len(ps) > 1 else [])
        for kind, k, u in units:
            if len(words_of(u)) > 1:
                score, _, best = max((dice(u, t), -n, n) for n, (_, t) in enumerate(known))
                if score >= THRESHOLD:
                    want[(i, kind, k)] = (known[best][0], best, round(score, 9))
    assert got == want
    assert ("ISC" in {v[0] for v in got.values()}) and got[(3, "line", 0)][0] == "GPL-2.0"


def test_reserved_rights_bodies_and_notices_inside_lines(make_docs):
    from revlens.llm.licenses import CLAUSES, WARRANTY
    from revlens.llm.licensetexts import TEXTS as LONG

    bsd = f"Copyright (c) 1999 A. Body\n\n1. {CLAUSES[0]}\n\n2. {CLAUSES[1]}\n\n{WARRANTY.format('HOLDER')}"
    rows = [(1, "All rights reserved."), (2, "# SPDX-License-Identifier: GPL-3.0-or-later"), (3, bsd), (4, "A tool for sums and other long things we do. Released under the MIT License. Have fun with it, all of you.")]
    rows += [(10 + k, texts[len(texts) // 2].replace(" ", "\n", 3)) for k, texts in enumerate(LONG.values())]
    got = {}
    for r in scan_licenses(make_docs(rows)).collect():
        got.setdefault(r.doc_id, []).append((r.unit, r.license))
    assert got[1] == [("line", "LicenseRef-All-Rights-Reserved")] and got[2] == [("line", "GPL-3.0")]
    assert len([x for x in got[3] if x == ("line", "BSD-2-Clause")]) == 3
    assert got[4] == [("sentence", "MIT")]
    assert all(("paragraph", licence) in got[10 + k] for k, licence in enumerate(LONG))


@pytest.mark.parametrize("t", [0.5, 0.8, 0.95])
def test_units_that_match_hold_a_key_bigram(t):
    """Dropping as many bigrams from a template as the threshold allows leaves one of its keys."""
    rng = random.Random(3)
    known = templates()
    keys = key_bigrams(known, t)
    for k in rng.sample(sorted(keys), 60):
        words = words_of(known[k][1])
        bag = [" ".join(b) for b in zip(words, words[1:])]
        order = sorted(bag, key=lambda b: b in keys[k])  # the keys go last, so they're what a unit drops first
        most = order[: math.ceil(t / (2 - t) * len(bag) - 1e-9)]
        assert set(most) & set(keys[k])


def test_nasty_and_empty(nasty, empty):
    assert scan_licenses(nasty).count() == 0
    assert scan_licenses(empty).count() == 0


def test_repeated_rows_are_scanned_each(make_docs):
    rows = scan_licenses(make_docs([(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "Licensed under the MIT License")]))
    assert sorted((str(r.doc_id), r.dice) for r in rows.collect()) == [("1", 1.0), ("1", 1.0), ("None", 1.0)]


@pytest.mark.parametrize("t", [0.6, 0.8, 0.95])
def test_sql_agrees(make_docs, t, tmp_path):
    docs = make_docs(TEXTS)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = con.execute(scan_sql(templates(), t)).fetchall()
    got = scan_licenses(docs, threshold=t).collect()
    assert sorted(map(tuple, got)) == sorted(want)
