"""Ranked lexical search, reversed: the items' terms are the index and the documents stream through it.

1. Items are dealt to blocks of bounded size. A block's inverted index (term to items and how often each
   holds it) is built from its rows and broadcast; its bytes are measured before anything is collected.
2. A first pass over the documents counts what the weights need: documents, terms, and how many documents
   hold each indexed term. Only indexed terms are counted, and tasks add up before the shuffle.
3. A second pass streams each document's term counts through the index: its terms' postings add to one
   score per item, and a bounded heap per item keeps the best documents of the task.
4. The heaps are merged in two levels (groups of tasks, then all), so that no task reads a row from every
   other task.

A benchmark beyond the size of a block takes one pair of passes per block, never a larger broadcast.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.registry import query, table
from revlens.llm.tables import cut

#: Bytes that are part of a term: digits, letters and everything beyond ASCII; A-Z become a-z, the rest spaces.
TERM_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
#: Bytes that a posting and a term take in the index, Python's own included; an upper estimate.
POSTING_BYTES, TERM_OVERHEAD = 24, 150


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order; none for null."""
    return text.translate(TERM_BYTES).split() if text else []


class Index(NamedTuple):
    """Inverted index of one block: the postings of term t are ``items[at[t]:at[t + 1]]``."""

    terms: dict[bytes, int]
    at: np.ndarray
    items: np.ndarray
    counts: np.ndarray
    n_items: int


class Facts(NamedTuple):
    """Statistics of all documents: those with a term, their terms with repeats, documents by indexed term."""

    documents: int
    tokens: int
    df: np.ndarray


def weights_of(facts: Facts) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * facts.documents + 2) / (2 * int(d) + 1))) for d in facts.df], np.int64)


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def item_postings(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(key, item_id, term, n): a row for each distinct term of an item.

    ``key`` parts items with one id and different texts; equal rows are one item.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(utf8(b.column(2))):
                found: dict[bytes, int] = {}
                for t in terms_of(text):
                    found[t] = found.get(t, 0) + 1
                if found:
                    n = len(found)
                    rows = [b.column(0).take(pa.array([i] * n)), b.column(1).take(pa.array([i] * n))]
                    yield pa.RecordBatch.from_arrays(
                        [*rows, pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["key", "item_id", "term", "n"]
                    )

    text = F.col(f"`{text_col}`").cast("string")
    src = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), text.alias("text")).distinct()
    return src.select(F.xxhash64("item_id", "text").alias("key"), "item_id", "text").mapInArrow(run, "key long, item_id long, term binary, n long")


def deal_blocks(postings: DataFrame, block_bytes: int) -> tuple[int, list[int]]:
    """A number of blocks by which no block of items takes more than ``block_bytes``, unless it is one item,
    and the blocks that have items."""
    size = F.sum(F.length("term") + POSTING_BYTES + TERM_OVERHEAD)
    blocks = -(-(postings.agg(size.alias("n")).first()["n"] or 0) // block_bytes)
    while blocks:
        sizes = postings.groupBy(F.pmod("key", F.lit(blocks)).alias("block")).agg(size.alias("n"), (F.min("key") < F.max("key")).alias("several")).collect()
        if not any(r["several"] and r["n"] > block_bytes for r in sizes):
            return blocks, sorted(r["block"] for r in sizes)
        blocks *= 2
    return 0, []


def index_of(rows: pa.Table) -> tuple[Index, list[tuple[int, int | None]]]:
    """The index of a block's postings, and (key, item_id) by item number."""
    numbers: dict[tuple[int, int | None], int] = {}
    item = [numbers.setdefault(k, len(numbers)) for k in zip(rows.column("key").to_pylist(), rows.column("item_id").to_pylist(), strict=True)]
    terms: dict[bytes, int] = {}
    term = np.array([terms.setdefault(t, len(terms)) for t in rows.column("term").to_pylist()], np.int64)
    order = np.argsort(term, kind="stable")
    at = np.searchsorted(term[order], np.arange(len(terms) + 1))
    return Index(terms, at, np.array(item, np.int32)[order], rows.column("n").to_numpy()[order], len(numbers)), list(numbers)


def count_facts(docs: DataFrame, index) -> Facts:
    """One pass over (doc_id, text) for the statistics; a task adds up before its rows leave it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.value.terms.get
        df = np.zeros(len(index.value.terms), np.int64)
        documents = tokens = 0
        for b in batches:
            for text in utf8(b.column(0)):
                words = terms_of(text)
                documents += bool(words)
                tokens += len(words)
                found = set(map(get, words))
                found.discard(None)
                df[list(found)] += 1
        at = np.flatnonzero(df)
        keys, counts = np.append(at, [-1, -2]), np.append(df[at], [documents, tokens])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(rows.column("term").to_pylist(), rows.column("n").to_pylist(), strict=True))
    df = np.array([found.get(t, 0) for t in range(len(index.value.terms))], np.int64)
    return Facts(found.get(-1, 0), found.get(-2, 0), df)


class Heaps:
    """The best ``k`` documents of every item: highest score, then smallest doc_id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, float | int]]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # scores below can't enter

    def offer(self, doc_id: int | None, scores: np.ndarray) -> None:
        after = -math.inf if doc_id is None else -doc_id
        for i in np.flatnonzero(scores >= self.least).tolist():
            heap = self.rows[i]
            if len(heap) < self.k:
                heapq.heappush(heap, (int(scores[i]), after))
            else:
                heapq.heappushpop(heap, (int(scores[i]), after))
            if len(heap) == self.k:
                self.least[i] = heap[0][0]


def score_document(index: Index, weights: np.ndarray, facts: Facts, words: list[bytes]) -> np.ndarray | None:
    """The score of one document for every item of the block, or None if it shares no term."""
    get = index.terms.get
    known = [t for t in map(get, words) if t is not None]
    if not known:
        return None
    term, tf = np.unique(np.array(known, np.int64), return_counts=True)
    m = 100 - 25 + (25 * len(words) * facts.documents) // facts.tokens
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    first, size = index.at[term], index.at[term + 1] - index.at[term]
    posting = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
    scores = np.zeros(index.n_items, np.int64)
    np.add.at(scores, index.items[posting], index.counts[posting] * np.repeat(part, size))
    return scores


def block_heaps(docs: DataFrame, index, facts: Facts, k: int) -> DataFrame:
    """(item, doc_id, score, task): the heaps of every task that read (doc_id, text)."""
    weights = weights_of(facts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        heaps = Heaps(held.n_items, k)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                words = terms_of(text)
                scores = score_document(held, weights, facts, words) if words else None
                if scores is not None:
                    heaps.offer(doc_id, scores)
        rows = [(i, None if d == -math.inf else -d, s) for i, heap in enumerate(heaps.rows) for s, d in heap]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], ["item", "doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, "item int, doc_id long, score long")
    return found.withColumn("task", F.spark_partition_id())


def merge_heaps(heaps: DataFrame, k: int, tasks: int) -> DataFrame:
    """The best ``k`` rows of each item with their rank; heaps meet in groups of about sqrt(tasks) first."""
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    groups = max(1, math.isqrt(tasks))
    nth = F.row_number().over(Window.partitionBy("item", "group").orderBy(*best))
    some = heaps.withColumn("group", F.pmod("task", F.lit(groups))).withColumn("nth", nth).where(F.col("nth") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*best))
    return some.select("item", "doc_id", "score").withColumn("rank", rank).where(F.col("rank") <= k)


def rank_documents(
    items: DataFrame,
    docs: DataFrame,
    k: int = 20,
    item_col: str = "item_id",
    doc_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 64 << 20,
) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: item_id, rank (from 1), doc_id, score.

    Terms are the longest stretches of letters, digits and characters beyond ASCII, A-Z lower-cased; a
    document's score sums integer weights over the item's terms, repeats included (see ``score_document``).
    Scores of 0 aren't listed, so items without terms (null or empty text) give no rows. Equal scores rank
    by doc_id, null ids last; a document row that occurs twice is ranked twice. Equal item rows are one
    item; rows with one id and different texts are items of their own. An empty table on either side gives
    no rows. Other columns are ignored. Texts of any length are read whole, one at a time.

    ``block_bytes`` bounds the broadcast index. It can be passed only by a single item larger than that.
    """
    spark = docs.sparkSession
    postings = cut(item_postings(items, item_col, text_col), "postings")
    blocks, own = deal_blocks(postings, block_bytes)
    src = docs.select(F.col(f"`{doc_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in own:
        index, names = index_of(postings.where(F.pmod("key", F.lit(blocks)) == block).toArrow())
        shared = spark.sparkContext.broadcast(index)
        facts = count_facts(src, shared)
        if not facts.tokens:
            continue
        heaps = block_heaps(src, shared, facts, k)
        ids = spark.createDataFrame([(i, item_id) for i, (_, item_id) in enumerate(names)], "item int, item_id long")
        merged = merge_heaps(heaps, k, src.rdd.getNumPartitions())
        out = out.unionByName(merged.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


RANK_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
facts AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  GROUP BY doc_id, n, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), facts),
s AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), facts GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""


@query("op11_reversed_search", RANK_SQL)
def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
