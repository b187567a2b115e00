"""Exact top-k search: dual-tree search over cover trees, by integer inner product.

Rows are dealt to blocks that lie close together: nearest of ``pivots`` sampled rows, split by a hash of
the row into blocks of about ``block_rows``, so a vector that very many rows share fills many blocks.
Queries form blocks of ``query_rows``. A task gets one pair of blocks, builds a cover tree of each and
walks both trees together. A pair of nodes is pruned when

    max q.x <= cq.cd + rq |cd| + rd |cq| + rq rd

(c: centers, r: covering radii) is below the worst kth score in the query group. The first thresholds are
kth scores against a bounded sample (``seeds`` rows), which are lower bounds of the final ones. What comes
back is at most k rows per query and block; Spark merges them.

Every query block meets every data block (a stated query set against all rows, in blocks): the work of an
exact search is queries times rows wherever the bounds can't prune, as in many dimensions without clusters.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.registry import query, table
from revlens.llm.tables import cut, whole_groups

TOP, QUERY_STEP, UNIT = 10, 100, 1024


class Node:
    __slots__ = ("rows", "center", "radius", "norm", "children")

    def __init__(self, rows: np.ndarray, center: np.ndarray, radius: float):
        self.rows, self.center, self.radius = rows, center, radius
        self.norm = float(np.linalg.norm(center))
        self.children: list[Node] = []


def cover_tree(x: np.ndarray, leaf: int = 64, fan: int = 32) -> Node:
    """Cover tree of the rows of ``x``: a node's children are a net of its rows.

    The net is chosen farthest first until its radius is half of the node's, or has ``fan`` points; each
    row belongs to the nearest point. Radii are exact covering radii. Rows that all are one point are a leaf.
    """

    def build(rows: np.ndarray, at: int) -> Node:
        own = x[rows]
        gap = np.linalg.norm(own - x[at], axis=1)
        node = Node(rows, x[at], float(gap.max()))
        if len(rows) <= leaf or node.radius == 0:
            return node
        net, near = [at], np.zeros(len(rows), np.int64)
        while len(net) < fan and gap.max() > node.radius / 2:
            far = int(np.argmax(gap))
            d = np.linalg.norm(own - own[far], axis=1)
            closer = d < gap
            gap[closer], near[closer] = d[closer], len(net)
            net.append(int(rows[far]))
        node.children = [build(rows[near == j], c) for j, c in enumerate(net) if (near == j).any()]
        return node

    return build(np.arange(len(x)), 0)


class TopK:
    """Best k (score, id) of each query; ties to smaller ids."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.worst = k, floor.astype(float)
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64)) for _ in floor]

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.found[q][0], scores]), np.concatenate([self.found[q][1], ids])
        order = np.lexsort((i, -s))[: self.k]
        self.found[q] = s[order], i[order]
        if len(order) == self.k:
            self.worst[q] = max(self.worst[q], s[order[-1]])


def dual_search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, floor: np.ndarray) -> TopK:
    """Top k rows of ``x`` for the rows of ``q`` that score ``floor`` at least; a query's own id is left out.

    Scores are inner products in double precision, exact for integers whose sums stay below 2**53.
    """
    best = TopK(k, floor)
    stack = [(cover_tree(q), cover_tree(x))]
    while stack:
        a, b = stack.pop()
        bound = a.center @ b.center + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        if bound * (1 + 1e-9) + 1 < best.worst[a.rows].min():
            continue
        if not a.children and not b.children or len(a.rows) * len(b.rows) <= 1 << 12:
            scores = q[a.rows] @ x[b.rows].T
            scores[q_ids[a.rows][:, None] == x_ids[b.rows][None, :]] = -np.inf
            good = (scores >= best.worst[a.rows][:, None]) & np.isfinite(scores)
            for i in np.flatnonzero(good.any(axis=1)):
                best.add(int(a.rows[i]), scores[i, good[i]], x_ids[b.rows[good[i]]])
        elif b.children and (len(b.rows) >= len(a.rows) or not a.children):
            # the most promising node is walked first: it lifts the thresholds
            stack += sorted(((a, c) for c in b.children), key=lambda p: p[0].center @ p[1].center + p[1].radius * p[0].norm)
        else:
            stack += [(c, b) for c in a.children]
    return best


def integers_of(rows: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = (rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(rows), -1)


def large_rows(v: np.ndarray) -> np.ndarray:
    """Rows with a component so large that an inner product of two such rows may leave 2**53."""
    most = int((2**53 / max(1, v.shape[1])) ** 0.5)
    return ((v >= most) | (v <= -most)).any(axis=1)


def exact_best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Top k of every pair in integers of any size, for the rare rows that doubles can't score."""
    out = []
    wide = x.astype(object)
    for i, row in zip(q_ids.tolist(), q.astype(object), strict=True):
        scores = [(-max(-(2**63) + 1, min(2**63 - 1, int(s))), j) for s, j in zip(wide @ row, x_ids.tolist(), strict=True) if j != i]
        out += [(i, j, -s) for s, j in heapq.nsmallest(k, scores)]
    return out


def searched_blocks(k: int):
    """Arrow function over rows sorted by pair of blocks: best k rows per query and pair."""
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, "pair"):
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = t.slice(lo, hi - lo)
                is_query = own.column("floor").is_valid().to_numpy()
                queries, data = own.filter(pa.array(is_query)), own.filter(pa.array(~is_query))
                if not queries.num_rows or not data.num_rows:
                    continue
                q, x = integers_of(queries.column("v")), integers_of(data.column("v"))
                ids, x_ids, floor = queries.column("vec_id").to_numpy(), data.column("vec_id").to_numpy(), queries.column("floor").to_numpy()
                big_q, big_x = large_rows(q), large_rows(x)
                got = exact_best(q[big_q], ids[big_q], x, x_ids, k) if big_q.any() else []
                if big_x.any():
                    got += exact_best(q[~big_q], ids[~big_q], x[big_x], x_ids[big_x], k)
                if not big_q.all() and not big_x.all():
                    best = dual_search(q[~big_q].astype(float), ids[~big_q], x[~big_x].astype(float), x_ids[~big_x], k, floor[~big_q])
                    got += [(i, j, int(s)) for i, (ss, js) in zip(ids[~big_q], best.found, strict=True) for s, j in zip(ss, js, strict=True)]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got, strict=True)], names)

    return run


def usable(v: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def scaled(x: Column, unit: int) -> Column:
    """floor(unit * x) as a long, held within 64 bits."""
    most = F.lit(float(2**63 - 1024))
    return F.floor(F.greatest(-most, F.least(most, x * unit))).cast("long")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
    unit: int = UNIT,
    pivots: int = 32,
    seeds: int = 1024,
    block_rows: int = 4096,
    query_rows: int = 2048,
) -> DataFrame:
    """The ``k`` best rows of each query row: query_id, rank (from 1), vec_id, score.

    Components become floor(unit * x); the score is their integer inner product; ties go to the smaller
    vec_id; a query's own vec_id is no candidate. With fewer candidates than k all are returned.

    Null ids take no part; nor do vectors that are null, empty, or hold a null or non-finite component, nor
    pairs of different length (they have no inner product). Repeated rows are candidates once each. Rows
    with components too large for doubles are scored in integers of any size; scaled components and scores
    beyond 64 bits are held at the largest or smallest 64-bit number. An empty table gives no rows; other
    columns, whatever their names, are ignored except inside ``is_query``.
    """
    raw = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), raw.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = cut(rows.withColumn("v", F.transform("v", lambda x: scaled(x, unit))).withColumn("size", F.size("v")), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(seeds).select("vec_id", "v").collect()
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    for r in sample:
        by_size.setdefault(len(r["v"]), []).append((r["vec_id"], np.array(r["v"], float)))

    longest = {n: max(float(np.sqrt(p @ p)) for _, p in rows_) for n, rows_ in by_size.items()}

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Region (nearest pivot) of every row, and for queries the kth score in the sample."""
        for b in batches:
            region, floor = [], []
            for i, v, asks in zip(b.column("vec_id").to_pylist(), b.column("v").to_pylist(), b.column("is_query").to_pylist(), strict=True):
                known = by_size.get(len(v), [])
                x = np.array(v, float)
                region.append(int(np.argmin([np.sum((x - p) ** 2) for _, p in known[:pivots]])) if known else 0)
                scores = sorted((float(x @ p) for j, p in known if j != i), reverse=True) if asks else []
                # below the kth score whatever the rounding of doubles
                slack = 1 + 1e-9 * float(np.sqrt(x @ x)) * longest.get(len(v), 0.0)
                floor.append((scores[k - 1] - slack if len(scores) >= k else -np.inf) if asks else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(region, pa.int32()), pa.array(floor, pa.float64())], [*b.schema.names, "region", "floor"]
            )

    at = cut(rows.mapInArrow(placed, "vec_id long, v array<long>, is_query boolean, size int, region int, floor double"), "placed")
    counts = at.groupBy("size", "region").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    asked = at.where("is_query").groupBy("size").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("query_blocks"))
    deal = cut(counts.join(asked, "size"), "deal")
    data = at.join(F.broadcast(deal), ["size", "region"]) if deal.count() <= 10_000 else at.join(deal, ["size", "region"])
    data = data.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), "blocks"))
    data = data.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)))
    pair = F.xxhash64("size", "region", "block", "query_block").alias("pair")
    data = data.select(pair, "vec_id", "v", F.lit(None).cast("double").alias("floor"))
    asks = at.where("is_query").select("size", "vec_id", "v", "floor").join(deal, "size")
    asks = asks.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), "query_blocks"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(pair, "vec_id", "v", "floor")
    found = (
        data.unionByName(asks)
        .repartition("pair")
        .sortWithinPartitions("pair")
        .mapInArrow(searched_blocks(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_sql(k: int = TOP, step: int = QUERY_STEP, unit: int = UNIT) -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({unit} * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % {step} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {k}
"""


@query("op7_exact_top_k", top_k_sql())
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)
