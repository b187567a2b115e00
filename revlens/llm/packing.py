"""Packing: order-preserving dynamic programming over document and sentence ends.

The documents of one input partition are read in order as one stream of token ids. A sequence is
a window of that stream of at most ``window`` ids. Cutting is allowed at the end of a document (no
penalty), at the end of a sentence (``sentence_penalty``) and, inside sentences longer than
``hard_step`` ids, every ``hard_step`` ids (``hard_penalty``). With ``pos`` the candidate cuts,

    f(j) = penalty(j) + min over i of f(i) + padding(pos[j] - pos[i])

where padding is 0 at a power of two from ``exact_from`` on, else ``window`` minus the length.
Padding is linear in ``pos[i]`` inside the window, so the minimum of ``f(i) + pos[i]`` over the
sliding window comes from a monotone queue: O(1) per candidate. Lengths that are exact powers of two
are looked up beside it.

Scale: no shuffle and no driver state. A task holds one Arrow batch of texts and a buffer of about
``block_tokens`` ids (more only when one document is longer); the last sequence of a buffer is not
closed but opens the next one, so a block end costs nothing. Only the end of a partition pads.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.registry import query, table

END_ID = 1
WINDOW = 2048
TOKENIZER_FILE = "word_bpe_49k.json"

DOC, SENTENCE, HARD = 0, 1, 2


CLOSERS = "\"')]}»”’"
STOPS = (".", "!", "?", "…", "。", "！", "？")


class WordEncoder:
    """Token ids of white-space separated pieces of text; each distinct piece is encoded once.

    The tokenizer drops white space and never merges across it, so the ids of a text are the ids of its
    pieces in order. Words of Latin letters, with or without marks after them, go straight to its model
    (their bytes written as the model's byte alphabet has them), all else through the whole tokenizer. The table of known pieces is emptied when it has ``most_pieces``
    pieces or ``most_ids`` ids, which changes speed only.
    """

    SEP = "<|startoftext|>"
    SEP_ID = 49406
    MARKS = ".,;:!?"
    LATIN_END = "\u0180"

    def __init__(self, path: str, most_pieces: int = 800_000, most_ids: int = 16_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.most_pieces, self.most_ids = most_pieces, most_ids
        self.marks: dict[str, list[int]] = {}
        # the byte alphabet: printable bytes stand for themselves, the others follow from U+0100 on
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.alphabet = {b: 0x100 + i for i, b in enumerate(sorted(set(range(0x100)) - set(own)))}
        self.forget()

    def latin(self, word: str) -> str | None:
        """A word of composed Latin letters in the model's byte alphabet; None for any other."""
        if word.isascii():
            return word if word.isalpha() else None
        if not word.isalpha() or max(word) >= self.LATIN_END or "\u0130" in word:
            return None
        return word.lower().encode().decode("latin-1").translate(self.alphabet)

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.pool = np.array([END_ID], np.uint32)
        self.first = np.zeros(1, np.int64)  # entry 0 is the end of a document
        self.size = np.ones(1, np.int64)
        self.stop = np.zeros(1, bool)

    def whole(self, pieces: list[str]) -> list[list[int]]:
        """Ids by the whole tokenizer: many pieces at once, parted by a special token they don't hold."""
        out: list[list[int]] = []
        for lo in range(0, len(pieces), 2048):
            some = pieces[lo : lo + 2048]
            if any("<|" in p for p in some):
                out += [self.tokenizer.encode(p, add_special_tokens=False).ids for p in some]
                continue
            got = self.tokenizer.encode_batch_fast([self.SEP.join(some)], add_special_tokens=False)[0].ids
            cuts = [-1, *(i for i, x in enumerate(got) if x == self.SEP_ID), len(got)]
            out += [got[a + 1 : b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def learn(self, pieces: list[str]) -> None:
        """Add new pieces to the table."""
        ids: list[list[int] | None] = []
        tokenize = self.tokenizer.model.tokenize
        for p in pieces:
            word = p.rstrip(self.MARKS)
            plain = self.latin(word)
            if plain is not None:
                got = [t.id for t in tokenize(plain)]
                if len(word) < len(p):
                    end = p[len(word) :]
                    if end not in self.marks:
                        self.marks[end] = self.whole([end])[0]
                    got += self.marks[end]
                ids.append(got)
            else:
                ids.append(None)
        rest = [i for i, got in enumerate(ids) if got is None]
        for i, got in zip(rest, self.whole([pieces[i] for i in rest]), strict=True):
            ids[i] = got
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.code.update(zip(pieces, range(len(self.size), len(self.size) + len(pieces)), strict=True))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.stop = np.concatenate([self.stop, np.fromiter((p.rstrip(CLOSERS).endswith(STOPS) for p in pieces), bool, len(pieces))])
        self.pool = np.concatenate([self.pool, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum()))])

    def codes(self, pieces: list[str]) -> np.ndarray:
        """Entries of distinct pieces in the table."""
        if len(self.code) > self.most_pieces or len(self.pool) > self.most_ids:
            self.forget()
        new = [p for p in pieces if p not in self.code]
        if new:
            self.learn(new)
        return np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))


def encode_texts(texts: pa.Array, encoder: WordEncoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of the texts (each followed by END_ID), ids per text, and positions after sentence ends.

    ASCII letters are lowered first, as the tokenizer would, so that pieces differ by less.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    last = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    entries = encoder.codes(coded.dictionary.to_pylist())
    entry = np.insert(entries[coded.indices.to_numpy(zero_copy_only=False)], last, 0)
    n = encoder.size[entry]
    after = np.cumsum(n)
    ids = encoder.pool[np.repeat(encoder.first[entry] - after + n, n) + np.arange(int(n.sum()))]
    doc_after = after[last + np.arange(len(last))]
    return ids, np.diff(doc_after, prepend=0), after[encoder.stop[entry]]


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, hard_step: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions from 0 to the last document end, and the kind of each."""
    pos = np.unique(np.concatenate([[0], doc_ends, sentence_ends[sentence_ends < doc_ends[-1]]]).astype(np.int64))
    gaps = np.flatnonzero(np.diff(pos) > hard_step)
    if len(gaps):
        extra = np.concatenate([np.arange(pos[g] + hard_step, pos[g + 1], hard_step) for g in gaps])
        kind = np.concatenate([np.full(len(pos), SENTENCE), np.full(len(extra), HARD)])
        order = np.argsort(np.concatenate([pos, extra]), kind="stable")
        pos, kind = np.concatenate([pos, extra])[order], kind[order]
    else:
        kind = np.full(len(pos), SENTENCE)
    kind[np.searchsorted(pos, doc_ends)] = DOC
    kind[0] = DOC
    return pos, kind


def best_cuts(pos: np.ndarray, penalty: np.ndarray, window: int, exact_from: int) -> list[int]:
    """Indices into ``pos`` of the cheapest cuts, first and last included (the recurrence above).

    Ties: the longest window wins in the queue; an exact power of two wins over an equal padded cost.
    """
    m = len(pos)
    exact: dict[int, list[int]] = {}
    length = exact_from
    while length < window:
        at = np.searchsorted(pos, pos - length)
        hit = np.flatnonzero((pos >= length) & (pos[np.minimum(at, m - 1)] == pos - length))
        for j in hit:
            exact.setdefault(int(j), []).append(int(at[j]))
        length *= 2
    p, pen = pos.tolist(), penalty.tolist()
    f, back = [0.0] * m, [0] * m
    queue: deque[int] = deque([0])
    g = [0.0] * m
    for j in range(1, m):
        here = p[j]
        while p[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        best, who = g[i] + window - here, i
        if j in exact:
            for i in exact[j]:
                if f[i] <= best:
                    best, who = f[i], i
        f[j], back[j] = best + pen[j], who
        g[j] = now = f[j] + here
        while queue and g[queue[-1]] > now:
            queue.pop()
        queue.append(j)
    cuts = [m - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Packs a stream of documents; holds the open buffer between batches."""

    def __init__(self, base: int, window: int, penalties: tuple[float, float, float], hard_step: int, exact_from: int, block_tokens: int, with_ids: bool):
        self.next_id, self.window, self.penalties = base, window, np.array(penalties, float)
        self.hard_step, self.exact_from, self.block, self.with_ids = hard_step, exact_from, block_tokens, with_ids
        # open documents: [key, ids already emitted, ids of the document], and their ids and sentence ends
        self.docs: list[list] = []
        self.ids = np.zeros(0, np.uint32)
        self.doc_ends = np.zeros(0, np.int64)
        self.stops = np.zeros(0, np.int64)

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray, stops: np.ndarray) -> None:
        shift = len(self.ids)
        self.docs += [[k, 0, int(n)] for k, n in zip(keys, sizes, strict=True)]
        self.doc_ends = np.concatenate([self.doc_ends, shift + np.cumsum(sizes)])
        self.stops = np.concatenate([self.stops, shift + stops])
        self.ids = np.concatenate([self.ids, ids])

    def flush(self, last: bool) -> dict[str, list]:
        """Pieces of all closed sequences; without ``last`` the final sequence stays open."""
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cut", "ids")}
        if not self.docs:
            return out
        pos, kind = candidates(self.doc_ends, self.stops, self.hard_step)
        cuts = best_cuts(pos, self.penalties[kind], self.window, self.exact_from)
        if not last:
            cuts = cuts[:-1]
        d, at = 0, 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            lo, hi = int(pos[a]), int(pos[b])
            at = lo
            while at < hi:
                end = min(hi, int(self.doc_ends[d]))
                doc = self.docs[d]
                piece = self.ids[at:end]
                for k, v in (("doc_id", doc[0]), ("start", doc[1]), ("length", end - at), ("ids_crc32", zlib.crc32(piece.astype("<u4").tobytes())), ("doc_tokens", doc[2]), ("sequence_id", self.next_id), ("offset", at - lo), ("cut", ("document", "sentence", "hard")[kind[b]] if end == hi else "document")):
                    out[k].append(v)
                if self.with_ids:
                    out["ids"].append(piece.astype(np.int32))
                doc[1] += end - at
                at = end
                if end == self.doc_ends[d]:
                    d += 1
            self.next_id += 1
        self.docs, self.ids = self.docs[d:], self.ids[at:]
        self.doc_ends = self.doc_ends[d:] - at
        self.stops = self.stops[self.stops > at] - at
        return out


def slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // most_bytes
    bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:], strict=False) if b > a)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cut string"


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str, most_pieces: int) -> WordEncoder:
    """One encoder, with its cache, for all tasks that a Python worker runs."""
    return WordEncoder(path, most_pieces, 20 * most_pieces)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    window: int = WINDOW,
    sentence_penalty: float = 8.0,
    hard_penalty: float = 64.0,
    hard_step: int = 512,
    exact_from: int = 256,
    block_tokens: int = 1 << 18,
    with_ids: bool = True,
    most_pieces: int = 800_000,
) -> DataFrame:
    """Pack documents into sequences of at most ``window`` token ids; one row per piece.

    Columns: doc_id, start and length (of the piece in its document's ids, END_ID included),
    ids_crc32 (unsigned, over little-endian 32-bit ids), doc_tokens, sequence_id, offset (of the
    piece in its sequence, gapless from 0), cut (what ends the piece: document, sentence or hard) and,
    ``with_ids``, the ids themselves.

    ``tokenizer_path`` must be readable on every worker; None means the file that the workers' own
    ``public_tokenizers`` package names.

    ``most_pieces`` bounds a worker's table of known pieces: about 400 bytes each, less of them cost time only.

    Null text counts as empty: the document is its END_ID alone. A null id stays null. Repeated rows
    are packed once each. Very long texts span as many sequences as needed. An empty table gives no
    rows. Other columns of ``docs``, whatever their names, are ignored.
    """
    fields = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER_FILE)
        else:
            path = tokenizer_path
        encoder = shared_encoder(path, most_pieces)
        base = TaskContext.get().partitionId() << 32
        packer = Packer(base, window, (0.0, sentence_penalty, hard_penalty), hard_step, exact_from, block_tokens, with_ids)
        types = {"cut": pa.string(), "ids": pa.list_(pa.int32())}

        def batch(rows: dict[str, list]) -> pa.RecordBatch:
            names = [f.split()[0] for f in fields.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(rows[n], types.get(n, pa.int64())) for n in names], names)

        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for lo, hi in slices(texts, 4 << 20):
                part = texts[lo:hi]
                for a, z in slices(part, 1 << 20):  # bounds what encoding holds beside its result
                    packer.add(keys[lo + a : lo + z].to_pylist(), *encode_texts(part[a:z], encoder))
                if len(packer.ids) >= block_tokens:
                    yield batch(packer.flush(last=False))
        yield batch(packer.flush(last=True))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, fields)


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
