"""Approximate nearest neighbours: a neighbour graph by NN-descent, queries by greedy graph search.

Vectors that are equal are one node, named by its smallest vec_id. Nearness is the inner product: every
vector gets one more component that lifts all norms to the largest one, so that the nearest in the graph
are the largest inner products. Joins carry codes (one byte per component and a scale); the results are
scored on the original vectors.

Build: nodes meet in chunks, in the order of random-hyperplane buckets and once in random order, for a first graph of ``degree`` neighbours. Then
rounds of Spark joins: each node's neighbours, forward and backward, meet at that node; pairs of which
one is new since the last round are compared and sent to both ends if they beat the worst neighbour there.
It ends when fewer than ``least_new`` of all edges are new. Backward neighbours are sampled, ``degree`` at
most, as NN-descent does; the graph is an index, every vector is in it, and recall is measured.

Search: a query starts at its own node and at the ``entries`` longest vectors, and keeps a beam; in each
round the unexpanded nodes among its best ``beam`` are joined to their graph neighbours, and those not seen
before are scored. It ends when less than ``least_open`` of the queries have anything left to expand.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.covertree import usable
from revlens.llm.registry import query, table
from revlens.llm.tables import cut, runs, whole_groups
from revlens.llm.textcodes import mix

NEAREST, QUERY_STEP = 20, 20


def codes_of(v: np.ndarray, longest: float) -> list[bytes]:
    """Codes of rows: the lifted unit vector as a float32 scale and one signed byte per component."""
    lift = np.sqrt(np.maximum(longest**2 - (v**2).sum(1), 0))
    unit = np.concatenate([v, lift[:, None]], 1) / longest
    scale = np.maximum(np.abs(unit).max(1), 1e-30) / 127
    small = np.round(unit / scale[:, None]).astype(np.int8)
    return [s.tobytes() + c.tobytes() for s, c in zip(scale.astype(np.float32), small, strict=True)]


def decoded(codes: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = codes.to_pylist()
    if not raw:
        return np.zeros((0, 1), np.float32)
    both = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    return both[:, 4:].view(np.int8).astype(np.float32) * both[:, :4].copy().view(np.float32)


def best_per_key(key: np.ndarray, other: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` largest ``sim`` of each key."""
    order = np.lexsort((other, -sim, key))
    at = runs(key[order])
    nth = np.arange(len(order)) - np.repeat(at[:-1], np.diff(at))
    return order[nth < most]


def edge_batch(key: np.ndarray, other: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(other, pa.int64()), pa.array(sim, pa.float32())], ["node", "nbr", "sim"]
    )


def first_neighbours(degree: int, chunk: int):
    """Arrow function over rows in the order of their buckets: best neighbours inside chunks of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, y = b.column("node").to_numpy(), decoded(b.column("code"))
            edges = [*range(0, max(1, len(nodes) - chunk // 2), chunk), len(nodes)]
            for a, z in zip(edges, edges[1:], strict=False):
                if z - a < 2:
                    continue
                sim = y[a:z] @ y[a:z].T
                np.fill_diagonal(sim, -np.inf)
                most = min(degree, z - a - 1)
                top = np.argpartition(-sim, most - 1, axis=1)[:, :most]
                yield edge_batch(np.repeat(nodes[a:z], most), nodes[a:z][top].ravel(), np.take_along_axis(sim, top, 1).ravel())

    return run


def local_joins(degree: int, held: int = 2_000_000):
    """Arrow function over rows sorted by center: pairs of its neighbours that improve either end.

    The task keeps the best ``degree`` per node of what it has found, in pieces of about ``held`` pairs.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def squeezed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            a, b, s = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((b, a))  # a pair may be found at several centers
            a, b, s = a[order], b[order], s[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            a, b, s = a[new], b[new], s[new]
            keep = best_per_key(a, b, s, degree)
            return a[keep], b[keep], s[keep]

        for t, at in whole_groups(batches, "center"):
            nodes, fresh, worst = t.column("node").to_numpy(), t.column("fresh").to_numpy(zero_copy_only=False), t.column("worst").to_numpy()
            y = decoded(t.column("code"))
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if hi - lo < 2 or not fresh[lo:hi].any():
                    continue
                sim = y[lo:hi] @ y[lo:hi].T
                good = (fresh[lo:hi, None] | fresh[None, lo:hi]) & (sim > worst[lo:hi, None])
                good &= nodes[lo:hi, None] != nodes[None, lo:hi]
                i, j = np.nonzero(good)
                parts.append((nodes[lo + i], nodes[lo + j], sim[i, j]))
                size += len(i)
            if size > held:
                parts = [squeezed()]
                if len(parts[0][0]) > held // 2:
                    yield edge_batch(*parts.pop())
                size = sum(len(p[0]) for p in parts)
        if parts:
            yield edge_batch(*squeezed())

    return run


def best_edges(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` best neighbours of every node; an edge is fresh if none of its rows is old."""
    once = edges.repartition("node").groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    return once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= degree).drop("n")


def both_ways(graph: DataFrame, degree: int) -> DataFrame:
    """(center, node, fresh): a node's neighbours, and at most ``degree`` of those whose neighbour it is."""
    back = graph.select(F.col("nbr").alias("center"), F.col("node").alias("node"), "fresh")
    order = Window.partitionBy("center").orderBy(F.xxhash64("center", "node"))
    back = back.withColumn("n", F.row_number().over(order)).where(F.col("n") <= degree).drop("n")
    ahead = graph.select(F.col("node").alias("center"), F.col("nbr").alias("node"), "fresh")
    return ahead.unionByName(back).repartition("center").groupBy("center", "node").agg(F.max("fresh").alias("fresh"))


def small_side(nodes: int, dims: int, most_mb: int) -> bool:
    """Whether a table of codes may be broadcast: its size is known, 40 bytes a row besides the components."""
    return nodes * (dims + 40) <= most_mb << 20


def neighbour_graph(
    codes: DataFrame, nodes: int, dims: int, degree: int, tables: int, chunk: int, rounds: int, least_new: float, small: bool
) -> DataFrame:
    """(node, nbr, sim, fresh): the neighbour graph of ``codes`` (node, code)."""
    bits = max(0, int(np.ceil(np.log2(max(nodes, 1) / chunk))))
    planes = np.random.default_rng(9).normal(size=(dims + 1, max(1, tables * bits))).astype(np.float32)
    weights = 1 << np.arange(max(1, bits), dtype=np.int64)

    def buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            side = (decoded(b.column("code")) @ planes > 0).astype(np.int64)
            mixed = mix(b.column("node").to_numpy().view(np.uint64)) >> np.uint64(40)
            for t in range(tables + 1):  # the last order is random: it joins the chunks of the others
                bucket = side[:, t * bits : (t + 1) * bits] @ weights[:bits] if t < tables else mixed.astype(np.int64)
                bucket = bucket * (tables + 1) + t
                yield pa.RecordBatch.from_arrays([pa.array(bucket), *b.columns], ["bucket", *b.schema.names])

    met = codes.mapInArrow(buckets, "bucket long, node long, code binary")
    spread = met.repartitionByRange("bucket", F.xxhash64("node")).sortWithinPartitions("bucket", F.xxhash64("node"))
    graph = spread.mapInArrow(first_neighbours(degree, chunk), "node long, nbr long, sim float")
    # a node that met nobody starts at the first node
    first = codes.agg(F.min("node").alias("first")).first()["first"]
    lone = codes.select("node", F.lit(first).alias("nbr"), F.lit(-1.0).cast("float").alias("sim")).where("node <> nbr")
    graph = graph.unionByName(lone) if first is not None else graph
    graph = cut(best_edges(graph.withColumn("fresh", F.lit(True)), degree), "graph")
    for _ in range(rounds):
        worst = graph.groupBy("node").agg(F.when(F.count(F.lit(1)) >= degree, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
        facts = cut(codes.join(worst, "node", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0).cast("float"))), "facts")
        met = both_ways(graph, degree)
        met = met.join(F.broadcast(facts), "node") if small else met.join(facts, "node").repartition("center")
        found = met.sortWithinPartitions("center").mapInArrow(local_joins(degree), "node long, nbr long, sim float")
        old = graph.withColumn("fresh", F.lit(False))
        graph = cut(best_edges(old.unionByName(found.withColumn("fresh", F.lit(True))), degree), "graph")
        if graph.where("fresh").count() < least_new * degree * nodes:
            break
    return graph


def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function over rows sorted by q, of which one has node = q: similarity of q to all others."""
    for t, at in whole_groups(batches, "q"):
        q, node, y = t.column("q").to_numpy(), t.column("node").to_numpy(), decoded(t.column("code"))
        own = np.flatnonzero(t.column("own").to_numpy(zero_copy_only=False))
        base = np.repeat(own, np.diff(at)[np.isin(q[at[:-1]], q[own])])
        rest = np.isin(q, q[own])
        asker = y[base]
        asker[:, -1] = 0  # the lift of the norm is no part of an inner product
        sim = np.einsum("ij,ij->i", y[rest], asker)
        other = ~t.column("own").to_numpy(zero_copy_only=False)[rest]
        yield pa.RecordBatch.from_arrays(
            [pa.array(q[rest][other]), pa.array(node[rest][other]), pa.array(sim[other], pa.float32())], ["q", "node", "sim"]
        )


def greedy_search(
    queries: DataFrame, entries: list[int], graph: DataFrame, codes: DataFrame, degree: int, beam: int, least_open: float, small: bool
) -> DataFrame:
    """(q, node, sim) of everything that the queries (column q: a node) have seen, themselves included."""
    links = cut(both_ways(graph, degree).select("center", "node"), "links")
    askers = queries.join(codes.withColumnRenamed("node", "q"), "q").select("q", F.col("q").alias("node"), "code", F.lit(True).alias("own"))
    askers = cut(askers, "askers")
    seen = queries.select("q", F.col("q").alias("node"), F.lit(2.0).cast("float").alias("sim"), F.lit(False).alias("expanded"))
    order = Window.partitionBy("q").orderBy(F.desc("sim"), "node")
    seen = cut(seen, "seen")
    starts = queries.select("q", F.explode(F.array([F.lit(n).cast("long") for n in entries])).alias("node")) if entries else None
    asking = askers.count()
    while True:
        ranked = seen.withColumn("n", F.row_number().over(order))
        front = cut(ranked.where((F.col("n") <= beam) & ~F.col("expanded")).select("q", F.col("node").alias("center")), "front")
        if front.select("q").distinct().count() <= least_open * asking:
            break
        reached = front.join(links, "center").select("q", "node")
        reached = (reached if starts is None else reached.unionByName(starts)).distinct()
        starts = None
        new = reached.join(seen, ["q", "node"], "left_anti")
        with_codes = new.join(F.broadcast(codes) if small else codes, "node").select("q", "node", "code", F.lit(False).alias("own"))
        sims = with_codes.unionByName(askers).repartition("q").sortWithinPartitions("q").mapInArrow(scored, "q long, node long, sim float")
        done = ranked.withColumn("expanded", F.col("expanded") | (F.col("n") <= beam)).drop("n")
        seen = cut(done.unionByName(sims.withColumn("expanded", F.lit(False))), "seen")
    return seen.select("q", "node", "sim")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
    degree: int = 48,
    tables: int = 4,
    chunk: int = 256,
    rounds: int = 8,
    least_new: float = 0.02,
    beam: int = 64,
    entries: int = 16,
    least_open: float = 0.01,
    broadcast_mb: int = 64,
) -> DataFrame:
    """The ``k`` nearest rows found for each query row: query_id, rank (from 1), vec_id, score.

    Nearness is the inner product in double precision, ties go to the smaller vec_id, and a query's own
    vec_id is no candidate. The k reported are the nearest of those found.

    Null ids take no part, nor do vectors that are null, empty, zero, or hold a null or non-finite component.
    Vectors of each length are searched among themselves, one length after the other, since others have no
    inner product with them. Equal vectors share a node and are all candidates.
    An empty table gives no rows; other columns are ignored except inside ``is_query``.
    """
    raw = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), raw.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = cut(rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("square", square).where("square > 0"), "vectors")
    rows = rows.withColumn("size", F.size("v"))
    lengths = [r["size"] for r in rows.where("is_query").select("size").distinct().orderBy("size").collect()]
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dims in lengths:
        same = rows.where(F.col("size") == dims)
        out = out.unionByName(_of_one_length(same, dims, k, degree, tables, chunk, rounds, least_new, beam, entries, least_open, broadcast_mb))
    return out


def _of_one_length(
    rows: DataFrame, dims: int, k: int, degree: int, tables: int, chunk: int, rounds: int, least_new: float, beam: int, entries: int,
    least_open: float, broadcast_mb: int,
) -> DataFrame:
    """``nearest`` for rows (vec_id, v, is_query, square) whose vectors all have ``dims`` components."""
    grouped = cut(rows.groupBy("v").agg(F.min("vec_id").alias("node"), F.max("square").alias("square")), "nodes")
    size = grouped.agg(F.count(F.lit(1)).alias("nodes"), F.max("square").alias("top")).first()
    longest = float(np.sqrt(size["top"])) if size["nodes"] else 1.0

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(codes_of(v, longest), pa.binary())], ["node", "code"])

    codes = cut(grouped.select("node", "v").mapInArrow(coded, "node long, code binary"), "codes")
    small = small_side(size["nodes"], dims, broadcast_mb)
    graph = neighbour_graph(codes, size["nodes"], dims, degree, tables, chunk, rounds, least_new, small)

    known = rows.join(grouped.select("v", "node"), "v").select("vec_id", "is_query", "node")
    known = cut(known, "known")
    asking = known.where("is_query").select(F.col("node").alias("q"), F.col("vec_id").alias("query_id"))
    longest_nodes = [r["node"] for r in grouped.orderBy(F.desc("square"), "node").limit(entries).collect()]
    found = greedy_search(asking.select("q").distinct(), longest_nodes, graph, codes, degree, beam, least_open, small)
    order = Window.partitionBy("q").orderBy(F.desc("sim"), "node")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= 3 * k + 1).select("q", "node")
    exact = grouped.select("node", "v")
    pairs = best.join(exact, "node").join(exact.select(F.col("node").alias("q"), F.col("v").alias("w")), "q")
    dot = F.aggregate(F.zip_with("v", "w", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    pairs = cut(pairs.select("q", "node", dot.alias("score")), "scores")
    first = Window.partitionBy("node").orderBy("vec_id")
    members = known.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    lists = members.groupBy("node").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    close = pairs.join(lists, "node").select("q", "score", F.explode("ids").alias("vec_id"))
    # one list of k + 1 per node serves all queries at that node, which each leave out themselves
    first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    close = cut(close.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).drop("n"), "close")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(close, "q")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(mine))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query("op9_nearest_neighbours")
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)
