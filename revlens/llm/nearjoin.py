"""N-gram Jaccard join: chosen-path join over the word n-grams of documents.

Documents with the same n-gram set are one set from the first step on (a digest of the set names it).

1. Paths. In each run a set samples its own n-grams: n-gram j is chosen if a hash of (run, j) falls below
   1 / (threshold * size), so sets of Jaccard ``threshold`` share a chosen n-gram with probability about
   1 - 1/e. Runs repeat until ``1 - (1 - q) ** runs`` reaches ``recall``, where q is the chance to stay
   together over three such splits. Sets that share a path form a bucket.
2. Buckets of at most ``limit`` sets are compared by brute force, larger ones are split again: sets
   near the bucket's pivot leave with a link to it, all others sample the next step of their path from the
   minhash tokens of their sketch (the embedding of the set), and so on until no large bucket is left.
   Nothing is capped; a hot n-gram costs further splits, row by row and without grouping.
3. Comparison in buckets is coarse: sketches of 64 one-byte minhashes, kept pairs from an estimated
   similarity of ``near`` on. Sets closer to a pivot than ``absorb`` need no other partner there: by the
   triangle inequality of the Jaccard distance whatever they link to is near that pivot as well.
   Coarse links only say which sets meet in step 4: one cluster per connected component.
4. Exact check: the sets of each cluster are compared in blocks of ``block`` sets, block pair by block
   pair, which splits large clusters over tasks. The tasks return a link count per set and a spanning
   forest of the links, never the pairs.
5. Classes are the connected components of the exact links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.components import connected_components
from revlens.llm.registry import query, table
from revlens.llm.tables import cut, whole_groups
from revlens.llm.textcodes import character_table, code_points, mix, text_slabs, word_hashes

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
SKETCH = 64
_RNG = np.random.default_rng(20)
MINHASH_A = (_RNG.integers(1, 1 << 32, SKETCH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
MINHASH_B = _RNG.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32)
RUN_SEEDS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def runs_needed(recall: float, splits: int = 3) -> int:
    """Runs after which a pair at the threshold was together in a bucket with probability ``recall``."""
    q = 1.0
    for _ in range(splits):
        q = 1 - math.exp(-q)
    return min(len(RUN_SEEDS), math.ceil(math.log(1 - recall) / math.log(1 - q)))


def ngram_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word n-grams.

    Words are runs of letters and numbers in lower case. A text of fewer than ``n`` words, but one at
    least, has one n-gram: all its words. A text without words, or null, has an empty set.
    """
    codes, ends = code_points([(t or "").lower() for t in texts])
    h, starts = word_hashes(codes, character_table("alnum")[codes])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    grams = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + h[k : len(h) - n + 1 + k]
    grams = mix(grams)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            x = np.uint64(b - a)
            for w in h[a:b]:
                x = mix(np.array([x], np.uint64) * np.uint64(0xD6E8FEB86659FD93) + w)[0]
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketch_of(s: np.ndarray) -> bytes:
    """One byte of each of SKETCH minhashes."""
    low = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(low), 4096):
        best = np.minimum(best, (low[lo : lo + 4096, None] * MINHASH_A + MINHASH_B).min(axis=0))
    return (mix(best.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes()


def first_paths(s: np.ndarray, runs: int, threshold: float) -> np.ndarray:
    """Paths of one step: every n-gram that some run chooses."""
    most = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(s)))))
    chosen = [mix(s[s * seed <= most] ^ seed) for seed in RUN_SEEDS[:runs]]
    return np.concatenate(chosen).view(np.int64)


def set_rows(threshold: float, words: int, runs: int):
    """Arrow function: (doc_id, text) to (doc_id, sig, size, sketch, paths)."""
    names = ["doc_id", "sig", "size", "sketch", "paths"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in text_slabs(texts):
                sets = ngram_sets(texts[lo:hi], words)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(lo, hi - lo),
                        pa.array([digest(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([sketch_of(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([first_paths(s, runs, threshold) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names,
                )

    return run


def matrix(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(-1, SKETCH)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches, less the share of bytes that agree by chance."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (255 / 256)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Numbers of the links (a, b) of nodes 0 to n - 1 that join two parts not joined before."""
    root = list(range(n))
    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(k)
    return out


def bucket_links(near: float, absorb: float):
    """Arrow function over rows sorted by path: a spanning forest of the coarse links inside small buckets.

    In all buckets at once, the first set left is the pivot, all others are compared with it, and those
    that it absorbs leave; until no bucket has two sets left.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in whole_groups(batches, "path"):
            sigs = np.array(rows.column("sig").to_pylist(), object)
            sketches = matrix(rows.column("sketch").combine_chunks())
            path = rows.column("path").to_numpy()
            left, root = np.arange(len(path)), np.arange(len(path))
            a, b = [], []
            while len(left) > 1:
                p = path[left]
                start = np.concatenate([[True], p[1:] != p[:-1]])
                pivot = left[np.maximum.accumulate(np.where(start, np.arange(len(left)), 0))]
                sim = np.empty(len(left))
                for lo in range(0, len(left), 1 << 16):
                    some = slice(lo, lo + (1 << 16))
                    sim[some] = alike(sketches[left[some]], sketches[pivot[some]])
                # one link for each two parts that the pivots join
                link = np.flatnonzero((sim >= near) & (root[left] != root[pivot]))
                one = np.unique(root[pivot[link]] * len(path) + root[left[link]], return_index=True)[1]
                x, y = root[pivot[link[one]]], root[left[link[one]]]
                kept = forest(x, y, len(path))
                a.append(pivot[link[one[kept]]])
                b.append(left[link[one[kept]]])
                for i, j in zip(x[kept].tolist(), y[kept].tolist(), strict=True):
                    while root[i] != i:
                        i = root[i]
                    while root[j] != j:
                        j = root[j]
                    root[max(i, j)] = min(i, j)
                while (root[root] != root).any():
                    root = root[root]
                left = left[(sim < absorb) & ~start]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(sigs[np.concatenate(x)], pa.binary()) for x in (a, b)], ["a", "b"])

    return run


def split_buckets(near: float, absorb: float, threshold: float):
    """Arrow function over rows of large buckets with their pivot: links to it, and the next paths of the rest.

    A link has ``pivot`` set; a row that goes on has none and a longer path.
    """
    names = ["path", "sig", "sketch", "pivot"]
    most = np.uint64(int(2**64 / (threshold * SKETCH)))
    spot = np.arange(SKETCH, dtype=np.uint64) << np.uint64(8)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1 << 14):
                b = whole.slice(lo, 1 << 14)
                sketches = matrix(b.column("sketch"))
                own = np.array([x == y for x, y in zip(b.column("sig").to_pylist(), b.column("pivot").to_pylist(), strict=True)], bool)
                sim = alike(sketches, matrix(b.column("pivot_sketch")))
                link = np.flatnonzero((sim >= near) & ~own)
                if len(link):
                    got = b.take(pa.array(link))
                    yield pa.RecordBatch.from_arrays([got.column(n) for n in names], names)
                rest = np.flatnonzero((sim < absorb) & ~own)
                token = spot + sketches[rest].astype(np.uint64)
                path = mix(b.column("path").to_numpy()[rest].view(np.uint64)[:, None] ^ mix(token + np.uint64(1)))
                row, j = np.nonzero(mix(path + np.uint64(7)) <= most)
                if len(row):
                    got = b.take(pa.array(rest[row]))
                    new = pa.array(path[row, j].view(np.int64))
                    yield pa.RecordBatch.from_arrays([new, got.column("sig"), got.column("sketch"), pa.nulls(len(row), pa.binary())], names)

    return run


def coarse_links(sets: DataFrame, limit: int, near: float, absorb: float, threshold: float) -> DataFrame:
    """Links (a, b) of sets (sig, sketch, paths) that met in some bucket and look alike."""
    steps = sets.select("sig", F.explode("paths").alias("path"))
    shared = cut(steps.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    rows = steps.join(shared, "path").join(sets.select("sig", "sketch"), "sig")
    links = None
    while True:
        rows = cut(rows, "rows")
        small = rows.where(F.col("n") <= limit).select("path", "sig", "sketch")
        found = small.repartition("path").sortWithinPartitions("path", "sig").mapInArrow(bucket_links(near, absorb), "a binary, b binary")
        found = cut(found, "links")
        links = found if links is None else links.unionByName(found)
        large = rows.where(F.col("n") > limit)
        if large.isEmpty():
            return links
        pivots = cut(
            large.groupBy("path")
            .agg(F.min(F.struct(F.xxhash64("path", "sig").alias("h"), "sig", "sketch")).alias("m"))
            .select("path", F.col("m.sig").alias("pivot"), F.col("m.sketch").alias("pivot_sketch")),
            "pivots",
        )
        split = large.drop("n").join(pivots, "path").mapInArrow(
            split_buckets(near, absorb, threshold), "path long, sig binary, sketch binary, pivot binary"
        )
        split = cut(split, "split")
        links = links.unionByName(split.where("pivot IS NOT NULL").select(F.col("pivot").alias("a"), F.col("sig").alias("b")))
        on = split.where("pivot IS NULL").drop("pivot")
        shared = cut(on.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
        rows = on.join(shared, "path")


def set_binaries(words: int):
    """Arrow function: text rows of cluster members to their sets, where the set is the wanted one; a
    task returns each set once."""
    names = ["cluster", "sig", "copies", "blocks", "set"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            texts, wanted = b.column("text").to_pylist(), b.column("sig").to_pylist()
            for lo, hi in text_slabs(texts):
                sets = ngram_sets(texts[lo:hi], words)
                own = []
                for k, s in enumerate(sets):
                    if wanted[lo + k] not in seen and digest(s) == wanted[lo + k]:
                        seen.add(wanted[lo + k])
                        own.append(k)
                if own:
                    got = b.take(pa.array([lo + k for k in own]))
                    columns = [got.column(n) for n in names[:-1]] + [pa.array([sets[k].tobytes() for k in own], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by sparse columns in dense chunks."""
    every = [*left, *right]
    tokens = np.concatenate(every)
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((len(every), width), np.float32)
        dense[owner[a:b], column[a:b] - lo] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out


def check_blocks(threshold: float):
    """Arrow function over block pairs: exact links per set, and a spanning forest of them."""
    names = ["sig", "links", "to"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in whole_groups(batches, "pair"):
            out: list[tuple[bytes, int, bytes | None]] = []
            sigs, sides, copies = rows.column("sig").to_pylist(), rows.column("side").to_pylist(), rows.column("copies").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = [i for i in range(lo, hi) if i == lo or sigs[i] != sigs[i - 1]]  # a set may come from several rows
                one = [i for i in own if sides[i] != 1]
                two = one if sides[lo] == 2 else [i for i in own if sides[i] == 1]
                if not one or not two:
                    continue
                n1, n2 = np.array([len(sets[i]) for i in one]), np.array([len(sets[i]) for i in two])
                common = common_counts([sets[i] for i in one], [sets[i] for i in two])
                linked = common / (n1[:, None] + n2[None, :] - common) >= threshold
                if two is one:
                    np.fill_diagonal(linked, False)
                weight1, weight2 = np.array([copies[i] for i in one]), np.array([copies[i] for i in two])
                out += [(sigs[i], int(k), None) for i, k in zip(one, linked @ weight2, strict=True) if k]
                if two is not one:
                    out += [(sigs[i], int(k), None) for i, k in zip(two, weight1 @ linked, strict=True) if k]
                a, b = np.nonzero(linked)
                a, b = np.array(one)[a] - lo, np.array(two)[b] - lo
                out += [(sigs[lo + a[k]], 0, sigs[lo + b[k]]) for k in forest(a, b, hi - lo)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.binary()), strict=True)], names
                )

    return run


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    limit: int = 1024,
    near: float = 0.4,
    absorb: float = 0.7,
    block: int = 128,
    filter_ids: int = 5_000_000,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links.

    Two documents link if the Jaccard similarity of their word n-gram sets is ``threshold`` or more;
    ``n_links`` counts a document's partners, copies included, and a class is a connected component of
    links, named by its smallest doc_id. Reported links are exact; a link is found with probability
    ``recall`` at least.

    Documents without words (null, empty, only marks) link to nothing: each is its own class. Repeated rows
    are copies of each other. Null ids are allowed; a class of null ids only has a null name. Texts are
    read whole, whatever their length. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = cut(
        rows.mapInArrow(
            set_rows(threshold, words, runs_needed(recall)), "doc_id long, sig binary, size int, sketch binary, paths array<long>"
        ),
        "sets",
    )
    sets = cut(
        made.where("sig IS NOT NULL")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths")),
        "distinct",
    )
    links = coarse_links(sets, limit, near, absorb, threshold)
    clusters = cut(connected_components(links), "clusters").withColumnsRenamed({"node": "sig", "component": "cluster"})

    # exact check: texts of one document per set, in blocks
    counted = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    members = cut(clusters.join(cut(counted, "counted"), "cluster").join(sets.select("sig", "first_id", "copies"), "sig"), "members")
    wanted = members.withColumn("id", F.coalesce("first_id", F.lit(-(1 << 63)))).drop("first_id")
    texts = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "text")
    if wanted.count() <= filter_ids:  # 8 bytes each: drop other texts before the shuffle
        texts = texts.join(F.broadcast(wanted.select("id").distinct()), "id", "left_semi")
    texts = texts.join(wanted, "id")
    whole = texts.select("text", "cluster", "sig", "copies", "blocks").mapInArrow(
        set_binaries(words), "cluster binary, sig binary, copies long, blocks long, set binary"
    )
    placed = whole.withColumn("own", F.pmod(F.xxhash64("sig"), "blocks"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "sig",
        "copies",
        "set",
    )
    checked = cut(
        paired.repartition("pair").sortWithinPartitions("pair", "sig").mapInArrow(check_blocks(threshold), "sig binary, links long, to binary"),
        "checked",
    )
    classes = connected_components(checked.where("to IS NOT NULL").select(F.col("sig").alias("a"), F.col("to").alias("b")))
    classes = cut(classes.withColumnsRenamed({"node": "sig", "component": "class"}), "classes")
    named = classes.join(sets.select("sig", "first_id"), "sig").groupBy("class").agg(F.min("first_id").alias("class_id"))
    per_set = (
        sets.select("sig", "first_id", "copies")
        .join(checked.groupBy("sig").agg(F.sum("links").alias("links")), "sig", "left")
        .join(classes.join(cut(named, "named"), "class").select("sig", "class_id"), "sig", "left")
        .select(
            "sig",
            F.coalesce("class_id", "first_id").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    bare = made.where("sig IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    known = made.where("sig IS NOT NULL").select("doc_id", "sig")
    return known.join(cut(per_set, "per-set"), "sig").select("doc_id", "class_id", "n_links").unionByName(bare)


def join_sql(words: int = WORDS, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for op10: all pairs that share an n-gram, and the closure of their links."""
    return f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS ws FROM documents),
g AS (SELECT DISTINCT r, array_to_string(ws[i:i + {words - 1}], ' ') AS gram
      FROM (SELECT r, ws, unnest(range(1, greatest(1, len(ws) - {words - 2}))) AS i FROM w WHERE len(ws) > 0)),
h AS (SELECT r, doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w),
s AS (SELECT r, gram FROM g WHERE r IN (SELECT r FROM w WHERE len(ws) >= {words}) UNION ALL SELECT r, gram FROM h),
z AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.gram = b.gram AND a.r <> b.r
      JOIN z x ON x.r = a.r JOIN z y ON y.r = b.r GROUP BY a.r, b.r, x.n, y.n
      HAVING count(*)::DOUBLE / (x.n + y.n - count(*)) >= {threshold}::DOUBLE),
t AS (SELECT r AS a, r AS b FROM w UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a),
c AS (SELECT t.a AS r, min(w.doc_id) AS class_id FROM t JOIN w ON w.r = t.b GROUP BY t.a),
k AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(k.n, 0) AS n_links FROM w JOIN c USING (r) LEFT JOIN k USING (r)
"""


@query("op10_ngram_jaccard_join", join_sql())
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
