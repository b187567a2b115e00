"""Periodic run detection: Baier grouping, Lyndon roots, extension into runs.

A run is a stretch of words with smallest period q that is at least 2 q long and that no neighbouring
word extends. Every run has a Lyndon root under the order of words or under the reverse order, and the root
is the longest Lyndon word at its start. So, for each text:

1. Only words that stand in a repeated stretch of ``min_length // 2`` words can belong to a run of
   ``min_length`` words or more: every word of such a run is in one (``repeated``). The rest is left out,
   and what is left falls into stretches that hold whole runs.
2. Each stretch goes through phase one of Baier's suffix sorter, which groups suffixes by their longest
   Lyndon prefix, from the highest group down. The length of that prefix is the Lyndon array: no suffix is
   ever sorted. Both orders are grouped (``lyndon_array``).
3. Each prefix is a candidate root of its length. Its longest common extensions with the word one period on,
   to the right and to the left, are found for all candidates at once by binary search over prefix hashes.
   An extension of a period in all makes a run. Hashes only propose: every run is then compared word by
   word, and one that fails is extended word by word instead.

Texts are independent: no shuffle, one text at a time beyond a slab of short ones.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.lines import slabs, text_bytes
from revlens.llm.registry import query, table
from revlens.llm.tables import runs
from revlens.llm.textcodes import WORD_BASE, mix

ADDED = ["n_words", "runs", "collapsed"]


def lyndon_array(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every position: phase one of Baier's suffix sorter.

    A group holds the positions that share a context, the longest Lyndon prefix known so far; groups are
    a list in ascending order of contexts. The highest group is final. The position before a chain of its
    members takes them over: its context grows by theirs, and it moves to a new group just above its old
    one, the more copies it took over the higher. Positions taken over leave the list of open positions.
    """
    n = len(word)
    before, after = list(range(-1, n)), list(range(1, n + 2))
    letters = sorted(set(word))
    number = {c: g for g, c in enumerate(letters)}
    group = [number[c] for c in word]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(letters)
    below = list(range(-1, len(letters) - 1))
    above = list(range(1, len(letters) + 1))
    top = len(letters) - 1
    out = [0] * n
    while top >= 0:
        size = length[top]
        copies: dict[int, int] = {}
        for i in members[top]:
            if group[i] != top:
                continue
            out[i] = size
            p, q = before[i], after[i]
            before[q] = p
            if p >= 0:
                after[p] = q
                copies[p] = copies.get(p, 0) + 1
        members[top] = []
        if copies:
            made: dict[tuple[int, int], int] = {}
            by_copies = copies.items() if max(copies.values()) == 1 else sorted(copies.items(), key=lambda x: -x[1])
            for p, k in by_copies:
                old = group[p]
                g = made.get((old, k))
                if g is None:
                    # directly above the old group, and below those made from it with more copies
                    g = made[old, k] = len(members)
                    members.append([])
                    length.append(length[old] + k * size)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = g
                    below[up] = g
                members[g].append(p)
                group[p] = g
        top = below[top]
    return out


def repeated(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """Whether each word stands in a stretch of ``k`` words that its text holds twice.

    ``starts`` and ``ends`` bound each word's text. Unequal stretches may share a hash, which only lets
    more words through.
    """
    n = len(ids)
    first = np.flatnonzero(np.arange(n) + k <= ends)
    if len(first) < 2:
        return np.zeros(n, bool)
    values = mix(ids.astype(np.uint64) + np.uint64(1))
    h = mix(starts[first].astype(np.uint64) + np.uint64(1 << 40))
    for j in range(k):
        h = h * WORD_BASE + values[first + j]
    order = np.argsort(h)
    twin = np.zeros(len(h), bool)
    same = h[order[1:]] == h[order[:-1]]
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    on = first[twin]
    return np.cumsum(np.bincount(on, minlength=n + 1) - np.bincount(on + k, minlength=n + 1))[:n] > 0


def extend(ids: np.ndarray, i: int, p: int, lo: int, hi: int) -> tuple[int, int]:
    """The stretch around ``i`` within [lo, hi) whose words p apart are identical, word by word."""
    s, e = i, i + p
    while e < hi and ids[e] == ids[e - p]:
        e += 1
    while s > lo and ids[s - 1] == ids[s - 1 + p]:
        s -= 1
    return s, e


def roots_to_runs(ids: np.ndarray, at: np.ndarray, period: np.ndarray, lo: np.ndarray, hi: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs that the roots ``at`` of lengths ``period`` belong to.

    ``lo`` and ``hi`` bound each root's stretch of words.
    """
    power = np.full(len(ids) + 1, WORD_BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])

    def agree(a: np.ndarray, size: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words at ``a`` hash as those at ``a + p``."""
        return (prefix[a + size] - prefix[a]) * power[p] == prefix[a + p + size] - prefix[a + p]

    def longest(most: np.ndarray, test) -> np.ndarray:
        good, bad = np.zeros(len(most), np.int64), most + 1
        while (open_ := bad - good > 1).any():
            mid = np.where(open_, (good + bad) // 2, good)
            ok = test(mid)
            good, bad = np.where(open_ & ok, mid, good), np.where(open_ & ~ok, mid, bad)
        return good

    right = longest(hi - at - period, lambda x: agree(at, x, period))
    left = longest(at - lo, lambda x: agree(at - x, x, period))
    size = left + right + period
    is_run = (size >= 2 * period) & (size >= min_length)
    found: dict[tuple[int, int, int], tuple[int, int, int]] = {}
    for j in np.flatnonzero(is_run).tolist():
        p = int(period[j])
        found.setdefault((int(at[j] - left[j]), int(at[j] + p + right[j]), p), (int(at[j]), int(lo[j]), int(hi[j])))
    out = set()
    for (s, e, p), (i, low, high) in found.items():
        exact = np.array_equal(ids[s : e - p], ids[s + p : e])
        if not exact:
            s, e = extend(ids, i, p, low, high)
        if e - s >= max(min_length, 2 * p):
            out.add((s, e, p))
    return sorted(out)


def runs_of(ids: np.ndarray, at: np.ndarray, min_length: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of several texts; text t is ``ids[at[t]:at[t + 1]]``.

    Sorted by start, then period; ``min_length`` words or more, and two periods.
    """
    texts = len(at) - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(texts)]
    sizes = np.diff(at)
    starts, ends = np.repeat(at[:-1], sizes), np.repeat(at[1:], sizes)
    alive = repeated(ids, starts, ends, max(1, min_length // 2))
    # stretches of alive words, parted at the ends of texts
    key = np.where(alive, starts + 1, 0)
    bounds = runs(key)
    places, periods, lows, highs = [], [], [], []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if not key[lo] or hi - lo < min_length:
            continue
        word = ids[lo:hi].tolist()
        here = np.arange(lo, hi)
        for order in (word, [-c for c in word]):
            p = np.array(lyndon_array(order))
            # a root has the word one period on equal to its first, or the word before it to its last
            on = np.minimum(here + p, hi - 1)
            can = (p <= (hi - lo) // 2) & (((here + p < hi) & (ids[on] == ids[here])) | ((here > lo) & (ids[here - 1] == ids[here + p - 1])))
            places.append(here[can])
            periods.append(p[can])
            lows.append(np.full(int(can.sum()), lo))
            highs.append(np.full(int(can.sum()), hi))
    if places:
        text = np.searchsorted(at, np.arange(len(ids)), "right") - 1
        for s, e, p in roots_to_runs(ids, *(np.concatenate(x) for x in (places, periods, lows, highs)), min_length):
            t = int(text[s])
            out[t].append((s - int(at[t]), e - s, p))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words less those that a run holds after its first period, joined by spaces."""
    if found:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
    return b" ".join(words)


def find_runs(docs: DataFrame, min_length: int = 12, text_col: str = "text") -> DataFrame:
    """``docs`` with the runs of each text's words: ``n_words``, ``runs`` and ``collapsed``.

    Words are stretches without ASCII white space, compared byte by byte. ``runs`` lists (start, length,
    period) in words, by start, then period: every stretch of ``min_length`` words or more that is at least
    twice its smallest period and that no neighbour extends. ``collapsed`` is the text without the words
    that any run holds after its first period, joined by single spaces. Columns of these names are
    replaced, all others returned as they are, whatever their names. A null, empty or blank text has no
    words and no runs; repeated rows are searched each for itself; an empty table gives no rows. Texts are
    searched whole, in memory that grows with the longest one.
    """
    others = [c for c in docs.columns if c not in ADDED]
    row = (F.struct(*[F.col(f"`{c}`") for c in others])).alias("row")
    src = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), row)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slabs(b)):
            words = [(t or b"").split() for t in text_bytes(part)]
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
            ids = np.fromiter((number[w] for own in words for w in own), np.int64, int(at[-1]))
            found = runs_of(ids, at, min_length)
            spans = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in found]
            texts = [collapse(own, r) for own, r in zip(words, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(w) for w in words], pa.int64()), pa.array(spans, kind), pa.array(texts, pa.binary()).cast(pa.string()), part.column("row")],
                [*ADDED, "row"],
            )

    schema = f"n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string, row {src.schema['row'].dataType.simpleString()}"
    return src.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in others], *ADDED)


def planted(doc_id: Column, text: Column) -> Column:
    """The text with the word repetitions that the query's table is defined to have (see ``op13``)."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def looped(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        # the first a words, then the p words from a on over and over, cut at n
        period = F.slice(w, (a + 1).cast("int"), p.cast("int"))
        rest = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), rest), " ")

    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.element_at(F.transform(F.array(words), looped), 1)).otherwise(text)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("a"), (-r.period).alias("b"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return (
        find_runs(docs)
        .withColumn("best", longest)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("best.a")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.b")).alias("period"),
            F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.b")).cast("long").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
