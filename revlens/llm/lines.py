"""Line dedup: documents probe a sharded minimal perfect hash of the lines that many documents hold.

1. Every document gives its distinct line keys as 128-bit hashes; tasks count them before the shuffle, and
   the shuffle adds up in how many documents each key occurs. Lines themselves are never shuffled.
2. The keys that reach ``min_docs`` are dealt to shards by their hash. Each shard becomes a minimal perfect
   hash: a level is a bit array in which every key that hashes to a bit of its own sets it, the others go
   on to the next level. A key's number is its bit's rank; at that number the compact arrays hold a 48-bit
   fingerprint, which tells lines outside the index apart, and the count of documents.
3. The shards are broadcast in groups of bounded, measured size, and documents probe the arrays.

Where one group holds all shards, documents are probed and rewritten in one pass without a shuffle. Beyond
that each group takes a pass that marks line numbers by the hash of the text, and the marks are joined back.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.registry import query, table
from revlens.llm.tables import cut, runs
from revlens.llm.textcodes import mix

SPACE = b" \t\n\x0b\x0c\r"
#: Upper estimate of the index's bytes per key: about 4 bits of levels, 6 bytes of fingerprint, 4 of count.
KEY_BYTES = 12
FINGERPRINT = np.uint64((1 << 48) - 1)
ADDED = ["n_lines", "n_dropped", "dropped_docs"]


def line_keys(text: bytes | None) -> list[bytes]:
    """The key of every line: without white space at its ends, A-Z in lower case."""
    return [x.strip(SPACE).lower() for x in (text or b"").split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    return min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars


def hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits by key: the half that finds its place, and the half whose low bits are its fingerprint."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def shard_of(place: np.ndarray, shards: int) -> np.ndarray:
    """As ``shiftrightunsigned(place, 2) % shards`` in Spark, which has no unsigned numbers."""
    return ((place >> np.uint64(2)) % np.uint64(shards)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash over distinct pairs of 64-bit numbers, with a fingerprint and a count for each."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        self.sizes, self.words, self.low, self.high, self.counts = sizes, words, low, high, counts
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def bits(place: np.ndarray, fingerprint: np.ndarray, level: int, size: int) -> np.ndarray:
        """The bit of each key in a level; the odd factor differs by level, so distinct keys part at some level."""
        return (mix(place + fingerprint * np.uint64(2 * level + 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, place: np.ndarray, fingerprint: np.ndarray, counts: np.ndarray) -> PerfectHash:
        """Keys have no repeats; a level has twice as many bits as keys that are left, a word of 64 at least."""
        sizes, parts = [], []
        left = np.arange(len(place))
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = cls.bits(place[left], fingerprint[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        out = cls(np.array(sizes, np.int64), np.concatenate([*parts, np.zeros(0, np.uint64)]), *[np.zeros(0)] * 3)
        order = np.argsort(out.numbers(place, fingerprint))
        mark = (fingerprint & FINGERPRINT)[order]
        out.low, out.high = mark.astype(np.uint32), (mark >> np.uint64(32)).astype(np.uint16)
        out.counts = np.minimum(counts[order], np.iinfo(np.uint32).max).astype(np.uint32)
        return out

    def numbers(self, place: np.ndarray, fingerprint: np.ndarray) -> np.ndarray:
        """The number of each key of the set; for others any number, or -1."""
        out = np.full(len(place), -1, np.int64)
        open_ = np.arange(len(place))
        for level, size in enumerate(self.sizes.tolist()):
            bit = self.offsets[level] + self.bits(place[open_], fingerprint[open_], level, size)
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            found = (self.words[word] >> shift & np.uint64(1)).astype(bool)
            below = self.words[word[found]] & ((np.uint64(1) << shift[found]) - np.uint64(1))
            out[open_[found]] = self.ranks[word[found]] + np.bitwise_count(below)
            open_ = open_[~found]
        return out

    def counts_of(self, place: np.ndarray, fingerprint: np.ndarray) -> np.ndarray:
        """How many documents hold each line; 0 for lines outside the index."""
        at = self.numbers(place, fingerprint)
        here = at >= 0
        mark = fingerprint[here] & FINGERPRINT
        same = (self.low[at[here]] == mark.astype(np.uint32)) & (self.high[at[here]] == (mark >> np.uint64(32)).astype(np.uint16))
        out = np.zeros(len(place), np.int64)
        out[np.flatnonzero(here)[same]] = self.counts[at[here][same]]
        return out


ARRAYS = {"sizes": np.int64, "words": np.uint64, "low": np.uint32, "high": np.uint16, "counts": np.uint32}


def count_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(place, fingerprint, n): in how many rows of ``text`` each key of ``min_chars`` code points or more occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counted: dict[bytes, int] = {}
            for text in b.column(0).cast(pa.binary()).to_pylist():
                for key in set(line_keys(text)):
                    if long_enough(key, min_chars):
                        counted[key] = counted.get(key, 0) + 1
            place, fingerprint = hashes(list(counted))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.view(np.int64)), pa.array(fingerprint.view(np.int64)), pa.array(list(counted.values()), pa.int64())],
                ["place", "fingerprint", "n"],
            )

    rows = docs.select("text").mapInArrow(run, "place long, fingerprint long, n long")
    return rows.groupBy("place", "fingerprint").agg(F.sum("n").alias("n"))


def build_shards(keys: DataFrame, shards: int) -> DataFrame:
    """A row of arrays for each shard of (place, fingerprint, n); a shard is built in one task of its own size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if rows is None:
            return
        shard = rows.column("shard").to_numpy()
        place, fingerprint = (rows.column(c).to_numpy().view(np.uint64) for c in ("place", "fingerprint"))
        n = rows.column("n").to_numpy()
        at = runs(shard)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            built = PerfectHash.build(place[lo:hi], fingerprint[lo:hi], n[lo:hi])
            columns = [pa.array([getattr(built, a).tobytes()], pa.binary()) for a in ARRAYS]
            yield pa.RecordBatch.from_arrays([pa.array([int(shard[lo])], pa.int32()), *columns], ["shard", *ARRAYS])

    dealt = keys.withColumn("shard", (F.shiftrightunsigned("place", 2) % shards).cast("int"))
    schema = "shard int, " + ", ".join(f"{a} binary" for a in ARRAYS)
    return dealt.repartition(min(shards, 4096), "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


class Shards:
    """A group of shards held in memory; lines of other shards are not found."""

    def __init__(self, total: int, rows: pa.Table):
        self.total = total
        self.held = {
            r["shard"]: PerfectHash(*(np.frombuffer(r[a], kind) for a, kind in ARRAYS.items())) for r in rows.to_pylist()
        }

    def counts_of(self, place: np.ndarray, fingerprint: np.ndarray) -> np.ndarray:
        shard = shard_of(place, self.total)
        order = np.argsort(shard, kind="stable")
        out = np.zeros(len(place), np.int64)
        at = runs(shard[order])
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            held = self.held.get(int(shard[order[lo]]))
            if held is not None:
                out[order[lo:hi]] = held.counts_of(place[order[lo:hi]], fingerprint[order[lo:hi]])
        return out


def line_index(docs: DataFrame, min_docs: int, min_chars: int, shard_keys: int = 1 << 16, group_bytes: int = 128 << 20) -> list:
    """Broadcasts of ``Shards``, each of about ``group_bytes`` at most, for the lines of ``min_docs`` documents or more."""
    spark = docs.sparkSession
    keys = cut(count_lines(docs, min_chars).where(F.col("n") >= min_docs), "line-keys")
    total = keys.count()
    shards = -(-total // shard_keys)
    if not total:
        return []
    per_group = max(1, group_bytes // (KEY_BYTES * shard_keys))
    built = cut(build_shards(keys, shards), "line-shards")
    groups = []
    for lo in range(0, shards, per_group):
        rows = built.where(F.col("shard").between(lo, lo + per_group - 1)).toArrow()
        groups.append(spark.sparkContext.broadcast(Shards(shards, rows)))
    return groups


def probe(texts: list[bytes | None], shards: Shards | None, min_chars: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The lines of each text, and the document count of each line (0: not in the index)."""
    keys = [k for t in texts for k in line_keys(t)]
    distinct = [k for k in dict.fromkeys(keys) if long_enough(k, min_chars)] if shards else []
    counts = dict(zip(distinct, shards.counts_of(*hashes(distinct)).tolist(), strict=True)) if shards else {}
    found = np.fromiter((counts.get(k, 0) for k in keys), np.int64, len(keys))
    at = 0
    for t in texts:
        lines = (t or b"").split(b"\n")
        yield lines, found[at : at + len(lines)]
        at += len(lines)


def slabs(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, whose first column is the text, of about ``most`` bytes of text, one row at least."""
    lo = size = 0
    for i, n in enumerate(pc.binary_length(batch.column(0)).to_pylist()):
        size += n or 0
        if size >= most:
            yield batch.slice(lo, i + 1 - lo)
            lo, size = i + 1, 0
    if lo < batch.num_rows:
        yield batch.slice(lo)


def text_bytes(part: pa.RecordBatch) -> list[bytes | None]:
    return part.column(0).cast(pa.binary()).to_pylist()


def mark_lines(texts: DataFrame, groups: list, min_docs: int, min_chars: int) -> DataFrame:
    """(a, b, lines): by the two hashes of a distinct text its common lines' numbers and document counts.

    One pass over ``texts`` (text, a, b) for each group of shards; only texts with common lines give rows.
    """
    kind = pa.list_(pa.struct([("line", pa.int32()), ("n", pa.int64())]))

    def marked(group) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in (p for b in batches for p in slabs(b)):
                counts = [c for _, c in probe(text_bytes(part), group.value, min_chars)]
                hit = [i for i, c in enumerate(counts) if (c >= min_docs).any()]
                lines = [[{"line": k, "n": int(counts[i][k])} for k in np.flatnonzero(counts[i] >= min_docs).tolist()] for i in hit]
                at = pa.array(hit, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(1).take(at), part.column(2).take(at), pa.array(lines, kind)], ["a", "b", "lines"])

        return texts.mapInArrow(run, "a long, b long, lines array<struct<line:int,n:bigint>>").dropDuplicates(["a", "b"])

    marks = functools.reduce(DataFrame.unionByName, [marked(g) for g in groups])
    return marks.groupBy("a", "b").agg(F.flatten(F.collect_list("lines")).alias("lines"))


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", shard_keys: int = 1 << 16, group_bytes: int = 128 << 20
) -> DataFrame:
    """``docs`` with its text less the lines whose key is found in ``min_docs`` documents or more.

    Texts are split at each line feed; a key is the line without ASCII white space at its ends, A-Z in
    lower case, and needs ``min_chars`` code points. All lines of a common key go, in every document; the
    others stay as they are, joined by line feeds. Adds ``n_lines`` (before), ``n_dropped`` and
    ``dropped_docs`` (the largest document count among the dropped lines, null if none), replacing columns
    of these names; all other columns are returned as they are. Every row is a document of its own, also
    where ids or whole rows repeat or are null. A null or empty text is one empty line and becomes empty,
    as does a text that loses all lines. An empty table gives no rows.
    """
    others = [c for c in docs.columns if c not in (text_col, *ADDED)]
    row = (F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("string")).alias("row")
    src = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), row)
    groups = line_index(src.select("text"), min_docs, min_chars, shard_keys, group_bytes)

    def rewrite(counted):
        """For mapInArrow; ``counted(slab)`` gives the lines of each text and their document counts."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in (p for b in batches for p in slabs(b)):
                out, n, dropped, most = [], [], [], []
                for lines, counts in counted(part):
                    gone = counts >= min_docs
                    out.append(b"\n".join(x for x, g in zip(lines, gone.tolist(), strict=True) if not g))
                    n.append(len(lines))
                    dropped.append(int(gone.sum()))
                    most.append(int(counts[gone].max()) if gone.any() else None)
                columns = [pa.array(out, pa.binary()).cast(pa.string()), *(pa.array(x, pa.int64()) for x in (n, dropped, most))]
                yield pa.RecordBatch.from_arrays([*columns, part.column("row")], ["text", *ADDED, "row"])

        return run

    schema = f"text string, {', '.join(f'{c} long' for c in ADDED)}, row {src.schema['row'].dataType.simpleString()}"
    if len(groups) <= 1:
        only = groups[0] if groups else None
        out = src.mapInArrow(rewrite(lambda part: probe(text_bytes(part), only and only.value, min_chars)), schema)
    else:
        keyed = src.select("text", F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit("second")).alias("b"), "row")
        marks = mark_lines(keyed.select("text", "a", "b"), groups, min_docs, min_chars)

        def counted(part: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray]]:
            for text, found in zip(text_bytes(part), part.column("lines").to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                counts = np.zeros(len(lines), np.int64)
                for m in found or ():
                    counts[m["line"]] = m["n"]
                yield lines, counts

        out = keyed.join(marks, ["a", "b"], "left").select("text", "lines", "row").mapInArrow(rewrite(counted), schema)
    back = {text_col: F.col("text")} | {c: F.col(f"row.`{c}`") for c in others}
    return out.select(*[back[c].alias(c) for c in docs.columns if c in back], *ADDED)


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
common AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN common c ON l.key = c.key GROUP BY doc_id
"""


@query("op12_line_dedup", LINES_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
