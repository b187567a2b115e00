"""LM scoring: a Katz backoff bigram model, trained and evaluated in partitioned tables.

    P(w | v) = d(c(v w)) c(v w) / (c(v) + 1)    if v w was seen in training
             = a(v) P(w)                        else;  P(w) itself where v was not seen
    P(w)     = d(c(w)) c(w) / (N + 1),          the rest of the mass is the one unknown word's

d are Good-Turing discounts for counts up to ``CUTOFF`` (1 above), a(v) makes the sum over all words
exactly 1: ``a(v) = (1 - sum of seen P(w | v)) / (1 - sum of P(w) over the same w)``. The one count added to
the denominators leaves mass for contexts all of whose counts are too large to be discounted. Where counts
of counts give no discount strictly between 0 and 1 (tiny corpora), ``(r - D) / r`` with
``D = n1 / (n1 + 2 n2)`` stands in. A text starts in the context START and ends with the token END.

Stages; rows hold compressed integer arrays, a slab is about ``slab_chars`` characters of whole documents:

1. encoded: one row per slab, its distinct words (64-bit hashes), their training counts, its tokens.
2. words: hash ranges of words from all slabs meet, give global counts, counts of counts, and word numbers
   (frequent words small), and go back to the slabs.
3. bigrams: each slab sends its (context, word, document) counts to buckets by context. A context so
   frequent that it would crowd a bucket is dealt by (context, word). A bucket adds up training counts,
   which are the model's table, and evaluates its part of every document: discounts of seen bigrams are
   counted by r, since they depend on counts of counts of all buckets, and unseen ones keep what a(v) needs.
4. scores: the parts of a slab meet again; with the discounts they become numbers, added per document.

Every table is written to the shared folder: ``words`` and ``bigrams`` (the model), ``parts``. The driver
holds totals, counts of counts and the sums of the few split contexts. Sums of parts are kept in single
precision, which bounds a score's relative error by about 1e-7. Memory of a task follows
``slab_chars`` and ``bucket_tokens``, not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.language import remainder
from revlens.llm.registry import query, table
from revlens.llm.tables import cut, whole_groups
from revlens.llm.textcodes import mix, word_hashes

CUTOFF = 5
END = np.uint64(0x45AD5EED0E0D0F17)
UNKNOWN, START, FIRST_WORD = 0, 1, 2  # word numbers


def squeeze(x: np.ndarray) -> bytes:
    """A compressed integer or float array: byte planes, zstd."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T if len(x) else np.zeros((0, 0), np.uint8)
    return zstandard.ZstdCompressor(level=4).compress(np.ascontiguousarray(planes).tobytes())


def expand(b: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def spans(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, END after each text, and tokens per text."""
    sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    codes = np.frombuffer("".join((t or "") + " " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    h, starts = word_hashes(codes, (codes != 32) & ((codes < 9) | (codes > 13)))
    upto = np.searchsorted(starts, np.cumsum(sizes))
    return np.insert(h, upto, END), np.diff(upto, prepend=0) + 1


def encode_slabs(slab_chars: int, ranges: int):
    """Arrow function: (doc_id, text, held) to one row per slab and range of word hashes.

    The row of range 0 carries the slab's documents and tokens as well.
    """
    names = ["slab", "part", "words", "counts", "doc_id", "held", "sizes", "tokens"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary()]

    def rows(slab: int, ids: list, held: list, texts: list) -> pa.RecordBatch:
        h, sizes = token_hashes(texts)
        words, tokens = np.unique(h, return_inverse=True)
        train = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(tokens[train], minlength=len(words)).astype(np.uint32)
        edges = np.searchsorted(words, (np.arange(1, ranges, dtype=np.float64) * 2.0**64 / ranges).astype(np.uint64))
        edges = [0, *edges.tolist(), len(words)]
        out = []
        for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            own = (ids, held, squeeze(sizes.astype(np.uint32)), squeeze(tokens.astype(np.uint32))) if p == 0 else (None,) * 4
            out.append((slab, p, squeeze(np.diff(words[a:b], prepend=np.uint64(0))), squeeze(counts[a:b]), *own))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list = []
        texts: list = []
        chars = 0
        for b in batches:
            for i, t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                held.append(h)
                chars += len(t or "") + 1
                if chars >= slab_chars:
                    yield rows(slab, ids, held, texts)
                    slab, ids, held, texts, chars = slab + 1, [], [], [], 0
        if texts:
            yield rows(slab, ids, held, texts)

    return run


SLABS = "slab long, part int, words binary, counts binary, doc_id array<long>, held array<boolean>, sizes binary, tokens binary"


def count_words(ranges: int):
    """Arrow function over rows sorted by part: for each slab the global counts and numbers of its words.

    One row per part has no slab: the table of words, with counts of counts.
    """
    names = ["part", "slab", "counts", "numbers", "hashes", "total", "distinct", "of_counts"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, "part"):
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = t.slice(lo, hi - lo)
                part = own.column("part")[0].as_py()
                words = [np.cumsum(expand(x, np.uint64), dtype=np.uint64) for x in own.column("words").to_pylist()]
                counts = np.concatenate([expand(x, np.uint32) for x in own.column("counts").to_pylist()])
                known, where = np.unique(np.concatenate(words), return_inverse=True)
                total = np.bincount(where, weights=counts, minlength=len(known)).astype(np.int64)
                rank = np.empty(len(known), np.int64)
                rank[np.argsort(-total, kind="stable")] = np.arange(len(known))
                number = np.where(total > 0, FIRST_WORD + rank * ranges + part, UNKNOWN)
                small = np.bincount(total[(total > 0) & (total <= CUTOFF + 1)], minlength=CUTOFF + 2)
                out = [(part, None, squeeze(total), squeeze(number), squeeze(np.diff(known, prepend=np.uint64(0))), int(total.sum()), int((total > 0).sum()), small.tolist())]
                cuts = np.cumsum([0, *map(len, words)])
                for slab, a, b in zip(own.column("slab").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    out.append((part, slab, squeeze(total[where[a:b]]), squeeze(number[where[a:b]]), None, None, None, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


WORDS = "part int, slab long, counts binary, numbers binary, hashes binary, total long, distinct long, of_counts array<long>"


def discounts(of_counts: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 0 to CUTOFF (that of 0 is 1 and not used)."""
    n = np.array(of_counts, float)
    r = np.arange(1, CUTOFF + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        adjusted = (r + 1) * n[2:] / n[1:-1] / r
        rest = (CUTOFF + 1) * n[-1] / n[1]
        d = (adjusted - rest) / (1 - rest)
    plain = n[1] / (n[1] + 2 * n[2]) if n[1] > 0 else 0.5
    d = np.where(np.isfinite(d) & (d > 0) & (d < 1), d, (r - plain) / r if 0 < plain < 1 else (r - 0.5) / r)
    return np.concatenate([[1.0], d])


@dataclass
class Unigrams:
    tokens: int  # N, training tokens
    distinct: int  # V
    texts: int  # training texts, the count of START
    discount: np.ndarray
    unknown: float  # probability of the unknown word

    def probability(self, counts: np.ndarray) -> np.ndarray:
        d = np.where(counts <= CUTOFF, self.discount[np.minimum(counts, CUTOFF)], 1.0)
        return np.where(counts > 0, d * counts / (self.tokens + 1), self.unknown)


def send_bigrams(uni: Unigrams, buckets: int, crowd: float):
    """Arrow function over slabs with their words' global counts: rows for the buckets, and one per slab.

    The slab's own row (a bucket below 0) has per document the base score, its tokens and known tokens, and the
    score of tokens after an unknown word, which need no bigram.
    """
    names = ["bucket", "slab", "contexts", "pairs", "context_counts", "words", "word_counts", "trained", "docs", "doc", "times", "sums", "known"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 11]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                answers = sorted(r["answers"], key=lambda a: a["part"])
                count = np.concatenate([expand(a["counts"], np.int64) for a in answers])
                number = np.concatenate([expand(a["numbers"], np.int64) for a in answers])
                token, size = expand(r["tokens"], np.uint32).astype(np.int64), expand(r["sizes"], np.uint32).astype(np.int64)
                doc = np.repeat(np.arange(len(size)), size)
                c = count[token]
                base = np.bincount(doc, weights=np.log10((c + 0.5) / (uni.tokens + 0.5 * (uni.distinct + 1))))
                known = np.bincount(doc, weights=c > 0).astype(np.uint32)
                # previous word of every token; START is one more local word
                before = np.concatenate([[0], token[:-1]])
                before[np.cumsum(size) - size] = len(count)
                number, count = np.append(number, START), np.append(count, uni.texts)
                log_p = np.log10(uni.probability(count))
                free = count[before] == 0
                alone = np.bincount(doc[free], weights=log_p[token[free]], minlength=len(size))
                # distinct (context, word, document), where words of no training count are one
                order = np.argsort(number, kind="stable")
                spot = np.empty(len(order), np.int64)
                spot[order] = np.cumsum(np.diff(number[order], prepend=-1) > 0) - 1
                table_number, first = np.unique(number, return_index=True)
                table_count = count[first]
                n_words, n_docs = len(table_number), len(size)
                key = (spot[before[~free]] * n_words + spot[token[~free]]) * n_docs + doc[~free]
                key, times = np.unique(key, return_counts=True)
                pair, own = key // n_docs, key % n_docs
                starts = np.flatnonzero(np.diff(pair, prepend=-1))
                pair = pair[starts]
                docs = np.diff(np.append(starts, len(key)))
                context, word = pair // n_words, pair % n_words
                held = np.array(r["held"], bool)
                trained = np.add.reduceat(np.where(held[own], 0, times), starts) if len(starts) else np.zeros(0, np.int64)
                a, w = table_number[context], table_number[word]
                shares = np.maximum(1, np.ceil(table_count[context] / crowd)).astype(np.uint64)
                bucket = (mix(a.astype(np.uint64) + (mix(w.astype(np.uint64)) % shares << np.uint64(40))) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
                out = [(-1 - r["slab"], r["slab"], *[None] * 9, squeeze(np.stack([base, alone]).ravel()), squeeze(known))]
                for k in range(buckets):
                    p = by[edges[k] : edges[k + 1]]
                    if not len(p):
                        continue
                    new = np.flatnonzero(np.diff(context[p], prepend=-1))
                    entry = np.repeat(starts[p], docs[p]) + spans(docs[p])
                    # document numbers rise inside a pair; differences squeeze better
                    step = np.diff(own[entry], prepend=0)
                    out.append(
                        (k, r["slab"], squeeze(np.diff(a[p][new], prepend=0)), squeeze(np.diff(np.append(new, len(p))).astype(np.uint32)), squeeze(table_count[context[p][new]]), squeeze(w[p]), squeeze(table_count[word[p]]), squeeze(trained[p].astype(np.uint32)), squeeze(docs[p].astype(np.uint32)), squeeze(step.astype(np.int32)), squeeze(times[entry].astype(np.uint32)), None, None)
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


BIGRAMS = "bucket long, slab long, contexts binary, pairs binary, context_counts binary, words binary, word_counts binary, trained binary, docs binary, doc binary, times binary, sums binary, known binary"


def evaluate_buckets(uni: Unigrams, crowd: float):
    """Arrow function over rows sorted by bucket: the bucket's part of the model, and of every document.

    A model row (no slab): contexts with their counts, numbers of pairs, words and bigram counts, and what
    a(v) takes per context: the sum of P(w) over seen words, and counts by r (0: above CUTOFF).
    A second one has the facts of crowded contexts only. A part row (of a slab): documents, sums, tokens by
    r, and for unseen bigrams the same facts of their contexts.
    """
    names = ["bucket", "slab", "contexts", "context_counts", "facts", "crowded", "pairs", "words", "bigrams", "doc", "sums", "by_r", "event_context", "event_doc", "event_times", "of_counts"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 13, pa.list_(pa.int64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, "bucket"):
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                rows = t.slice(lo, hi - lo).to_pylist()
                if rows[0]["bucket"] < 0:  # a slab's own row passes
                    out = [(r["bucket"], r["slab"], *[None] * 8, r["sums"], r["known"], *[None] * 4) for r in rows]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    continue
                a, w, ca, cw, trained = [], [], [], [], []
                for r in rows:
                    times = expand(r["pairs"], np.uint32)
                    a.append(np.repeat(np.cumsum(expand(r["contexts"], np.int64)), times))
                    ca.append(np.repeat(expand(r["context_counts"], np.int64), times))
                    w.append(expand(r["words"], np.int64))
                    cw.append(expand(r["word_counts"], np.int64))
                    trained.append(expand(r["trained"], np.uint32))
                cuts = np.cumsum([0, *map(len, w)])
                a, w, ca, cw, trained = (np.concatenate(x) for x in (a, w, ca, cw, trained))
                context, first, of = np.unique(a, return_index=True, return_inverse=True)
                context_count = ca[first]
                # the same bigram from several slabs: order by context, then word
                order = np.lexsort((w, of))
                new = np.concatenate([[True], (np.diff(of[order]) != 0) | (np.diff(w[order]) != 0)])
                pair = np.empty(len(w), np.int64)
                pair[order] = np.cumsum(new) - 1
                lead = order[new]
                count = np.bincount(pair, weights=trained).astype(np.int64)
                seen = count > 0
                p_word = uni.probability(cw[lead])
                r_of = np.where(count <= CUTOFF, count, 0)
                facts = np.zeros((len(context), CUTOFF + 2))
                facts[:, 0] = np.bincount(of[lead][seen], weights=p_word[seen], minlength=len(context))
                for k in range(CUTOFF + 1):
                    own = seen & (r_of == k)
                    facts[:, 1 + k] = np.bincount(of[lead][own], weights=count[own], minlength=len(context))
                small = np.bincount(count[seen & (count <= CUTOFF + 1)], minlength=CUTOFF + 2)
                k = rows[0]["bucket"]
                per = np.bincount(of[lead][seen], minlength=len(context))
                model = (k, None, squeeze(context), squeeze(context_count), squeeze(facts.ravel()), squeeze((context_count > crowd).astype(np.uint8)), squeeze(per.astype(np.uint32)), squeeze(w[lead][seen]), squeeze(count[seen].astype(np.uint32)), *[None] * 6, small.tolist())
                out = [model]
                split = context_count > crowd
                if split.any():
                    out.append((k, None, squeeze(context[split]), squeeze(context_count[split]), squeeze(facts[split].ravel()), *[None] * 11))
                value = np.where(seen, np.log10(np.maximum(count, 1) / (context_count[of[lead]] + 1)), np.log10(p_word))
                for r, x, z in zip(rows, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    docs = expand(r["docs"], np.uint32)
                    doc = np.cumsum(expand(r["doc"], np.int32), dtype=np.int64)
                    times = expand(r["times"], np.uint32).astype(np.int64)
                    mine = np.repeat(pair[x:z], docs)
                    present, doc = np.unique(doc, return_inverse=True)
                    sums = np.bincount(doc, weights=value[mine] * times)
                    kind = np.where(seen[mine], r_of[mine], -1)
                    by_r = np.stack([np.bincount(doc[kind == k], weights=times[kind == k], minlength=len(present)) for k in range(1, CUTOFF + 1)])
                    event = np.flatnonzero(kind < 0)
                    need, ev = np.unique(of[lead][mine[event]], return_inverse=True)
                    out.append(
                        (rows[0]["bucket"], r["slab"], squeeze(context[need]), squeeze(context_count[need]), squeeze(facts[need].ravel()), squeeze((context_count[need] > crowd).astype(np.uint8)), *[None] * 3, squeeze(present.astype(np.uint32)), squeeze(sums.astype(np.float32)), squeeze(by_r.astype(np.uint32).ravel()), squeeze(ev.astype(np.uint32)), squeeze(doc[event].astype(np.uint32)), squeeze(times[event].astype(np.uint32)), None)
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


PARTS = "bucket long, slab long, contexts binary, context_counts binary, facts binary, crowded binary, pairs binary, words binary, bigrams binary, doc binary, sums binary, by_r binary, event_context binary, event_doc binary, event_times binary, of_counts array<long>"


def backoff_weights(facts: np.ndarray, counts: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """a(v) from the facts per context (see ``evaluate_buckets``) and the contexts' counts."""
    weight = np.concatenate([[1.0], discount[1:]])
    left = 1 - facts[:, 1:] @ weight / (counts + 1)
    return left / (1 - facts[:, 0])


def crowded_facts(rows: Iterable) -> dict[int, np.ndarray]:
    """Facts of the contexts that were dealt over several buckets, added up."""
    out: dict[int, np.ndarray] = {}
    for r in rows:
        for a, f in zip(expand(r["contexts"], np.int64).tolist(), expand(r["facts"], np.float64).reshape(-1, CUTOFF + 2), strict=True):
            out[a] = out.get(a, 0) + f
    return out


def finish_slabs(discount: np.ndarray, crowded: dict[int, np.ndarray]):
    """Arrow function over rows sorted by slab: scores of a slab's documents, from its parts and its own row."""
    logs = np.log10(discount)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def part(r: dict, score: np.ndarray) -> None:
        doc = expand(r["doc"], np.uint32)
        score[doc] += expand(r["sums"], np.float32) + logs[1:] @ expand(r["by_r"], np.uint32).reshape(CUTOFF, -1)
        contexts, counts = expand(r["contexts"], np.int64), expand(r["context_counts"], np.int64)
        facts = expand(r["facts"], np.float64).reshape(-1, CUTOFF + 2)
        for i in np.flatnonzero(expand(r["crowded"], np.uint8)):
            facts[i] = crowded[int(contexts[i])]
        weight = np.log10(backoff_weights(facts, counts, discount))
        ev, times = expand(r["event_context"], np.uint32), expand(r["event_times"], np.uint32)
        score[doc] += np.bincount(expand(r["event_doc"], np.uint32), weights=weight[ev] * times, minlength=len(doc))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, "slab"):
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                rows = t.slice(lo, hi - lo).to_pylist()
                own = next(r for r in rows if r["bucket"] < 0)
                base, score = expand(own["sums"], np.float64).reshape(2, -1).copy()
                for r in rows:
                    if r["bucket"] >= 0:
                        part(r, score)
                columns = [own["doc_id"], own["held"], expand(own["sizes"], np.uint32), expand(own["by_r"], np.uint32), base, score]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def katz_scores(
    docs: DataFrame,
    held: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    slab_chars: int = 4_000_000,
    bucket_tokens: int = 2_200_000,
    ranges: int | None = None,
) -> DataFrame:
    """Scores of all documents under the model of those that are not ``held`` (a boolean column).

    Columns: doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (add
    one half unigrams), score (log10 probability). Null text is empty: its one token is END. Null ids stay
    null, a null in ``held`` counts as false, and repeated rows train and score once each. Texts are read
    whole. Where nothing is trained on, every token is the unknown word, of probability 1. An empty table
    gives no rows; other columns are ignored.

    ``ranges``, the number of hash ranges of words, follows the number of input partitions by default. For
    very large inputs raise slab_chars and bucket_tokens together: a slab sends one row to each bucket.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    ranges = ranges or max(16, 2 * rows.rdd.getNumPartitions())
    slabs = cut(rows.mapInArrow(encode_slabs(slab_chars, ranges), SLABS), "slabs")
    asked = slabs.select("part", "slab", "words", "counts").repartition(ranges, "part").sortWithinPartitions("part", "slab")
    words = cut(asked.mapInArrow(count_words(ranges), WORDS), "words")
    stats = words.where("slab IS NULL").select("total", "distinct", "of_counts").collect()
    of_counts = np.sum([r["of_counts"] for r in stats], axis=0).tolist() if stats else [0] * (CUTOFF + 2)
    texts = slabs.where("part = 0").select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    uni = Unigrams(sum(r["total"] for r in stats), sum(r["distinct"] for r in stats), int(texts), discounts(of_counts), 1.0)
    small = sum(r * of_counts[r] for r in range(1, CUTOFF + 1))
    kept = sum(uni.discount[r] * r * of_counts[r] for r in range(1, CUTOFF + 1))
    uni.unknown = 1 - (kept + uni.tokens - small) / (uni.tokens + 1)

    buckets = max(1, -(-uni.tokens // bucket_tokens))
    crowd = max(1.0, uni.tokens / (4 * buckets))
    answers = words.where("slab IS NOT NULL").groupBy("slab").agg(F.collect_list(F.struct("part", "counts", "numbers")).alias("answers"))
    ready = slabs.where("part = 0").select("slab", "held", "sizes", "tokens").join(answers, "slab")
    sent = ready.mapInArrow(send_bigrams(uni, buckets, crowd), BIGRAMS)
    bigrams = sent.repartition("bucket").sortWithinPartitions("bucket", "slab")
    parts = cut(bigrams.mapInArrow(evaluate_buckets(uni, crowd), PARTS), "bigrams")

    counts = parts.where("of_counts IS NOT NULL").select(F.posexplode("of_counts").alias("r", "n")).groupBy("r").agg(F.sum("n")).collect()
    found = dict.fromkeys(range(CUTOFF + 2), 0) | {r: n for r, n in counts}
    discount = discounts([found[r] for r in range(CUTOFF + 2)])
    crowded = crowded_facts(parts.where("slab IS NULL AND of_counts IS NULL").select("contexts", "facts").collect())
    mine = slabs.where("part = 0").select("slab", "doc_id", "held", "sizes")
    dealt = parts.where("slab IS NOT NULL")
    own = dealt.where("bucket < 0").join(mine, "slab").select(*dealt.columns, "doc_id", "held", "sizes")
    rest = dealt.where("bucket >= 0").drop("of_counts", "pairs", "words", "bigrams")
    whole = rest.unionByName(own, allowMissingColumns=True).drop("of_counts", "pairs", "words", "bigrams")
    numbers = whole.repartition("slab").sortWithinPartitions("slab").mapInArrow(finish_slabs(discount, crowded), SCORES)
    return numbers.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(uni.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 1)
