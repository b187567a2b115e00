"""LSI as a distributed randomised SVD (C2; Halko, Martinsson & Tropp 2011), many corpora at once.

The matrix is a long table (corpus, document, term, weight); no vocabulary limit, no dense matrix, and the
term factors V stay a table. Subspace iteration starts from random numbers for each term and goes to and fro:
Y = A Z by documents, W = A' Y by terms. Documents are dealt into blocks by a hash; a round sends each block the
rows of Z of its own terms only, and the block gives back one row of W for each of them and the R of its Y. So a
round's shuffles grow with the blocks' vocabularies and not with the entries, Y is never written, and the
blocks themselves stay where they are. As A' (Y T) is (A' Y) T, the turn T that makes Y orthonormal is applied to W.

Vectors are orthonormalised by tree QR: every task reduces its rows to one small R, trees of tasks merge the
Rs, and the driver gets at most ``FAN`` of them for each corpus (l x l numbers each, where l is the number of
components and some more). The SVD of R gives the singular values and the small matrix that turns the rows into
orthonormal columns, a map. The iteration ends when the singular values stand still.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.session import scratch_path
from revlens.sources.registry import new_run_id

FAN = 32
#: Singular values below this share of the largest are zero.
RANK = 1e-10
#: Smaller blocks than this would send more vectors than they save time.
SMALL_CELLS = 100_000


@dataclass(frozen=True)
class LsiModel:
    """terms (group, term, v array<double>): rows of V; singular: values by corpus, largest first."""

    terms: DataFrame
    group: str
    singular: dict


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{new_run_id()}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _lists(x: np.ndarray) -> pa.Array:
    rows, size = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * size, size), pa.int32()), pa.array(np.ascontiguousarray(x).reshape(-1)))


def _group_positions(column: pa.Array) -> Iterator[tuple[object, np.ndarray]]:
    coded = column.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    for k, g in enumerate(coded.dictionary.to_pylist()):
        yield g, np.flatnonzero(codes == k)


def tree_qr(table: DataFrame, group: str, size: int) -> dict:
    """R of the vectors ``v`` of each corpus: (size x size) upper triangles that have the same singular values."""
    kind = dict(table.dtypes)[group]

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for g, at in _group_positions(b.column(0)):
                rows = _vectors(b.column(1).take(pa.array(at)), size)
                held[g] = np.linalg.qr(np.concatenate([held[g], rows]) if g in held else rows, mode="r")
        if held:
            sizes = [len(r) for r in held.values()]
            groups = pa.array([g for g, n in zip(held, sizes) for _ in range(n)], groups_type)
            yield pa.RecordBatch.from_arrays([groups, _lists(np.concatenate(list(held.values())))], [group, "v"])

    groups_type = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[kind]
    schema = f"{group} {kind}, v array<double>"
    parts = table.rdd.getNumPartitions()
    small = table.select(group, "v").mapInArrow(reduce, schema)
    while parts > FAN:
        parts = -(-parts // FAN)
        small = small.repartition(parts).mapInArrow(reduce, schema)
    out: dict = {}
    for r in small.collect():  # at most FAN triangles for each corpus
        out.setdefault(r[group], []).append(r["v"])
    return {g: np.linalg.qr(np.array(rows), mode="r") for g, rows in out.items()}


def _turns(triangles: dict, size: int) -> tuple[dict, dict]:
    """By corpus the matrix that gives vectors of triangle R orthonormal columns, and the singular values.

    Directions without weight become columns of zeros."""
    turn, values = {}, {}
    for g, r in triangles.items():
        _, s, t = np.linalg.svd(r)
        s = np.concatenate([s, np.zeros(size - len(s))])
        live = s > RANK * max(s[0], 1e-300)
        turn[g] = np.where(live, t.T / np.where(live, s, 1), 0)
        values[g] = np.where(live, s, 0)
    return turn, values


def _turned(table: DataFrame, group: str, key: str, size: int, turn: dict) -> DataFrame:
    """``table`` (group, key, v) with each v multiplied by its corpus's matrix."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _vectors(b.column(2), size)
            out = np.zeros(v.shape)
            for g, at in _group_positions(b.column(0)):
                out[at] = v[at] @ turn[g]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(out)], [group, key, "v"])

    kinds = dict(table.dtypes)
    return table.select(group, key, "v").mapInArrow(apply, f"{group} {kinds[group]}, {key} {kinds[key]}, v array<double>")


def _blocks(entries: DataFrame, group: str, doc: str, term: str, weight: str, block_cells: int) -> tuple[DataFrame, int]:
    """The blocks as a written table, and their number.

    A row for each document: (group, block, at, w), the places of its terms in the block and their weights; and a
    row for each term of a block: (group, block, term, at), the place alone.
    """
    kinds = dict(entries.dtypes)
    schema = f"{group} {kinds[group]}, block int, {term} {kinds[term]}, at array<int>, w array<double>"
    counts = {r[group]: r["n"] for r in entries.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each corpus
    if not counts:
        return entries.sparkSession.createDataFrame([], schema), 0
    # every core has a block, unless blocks would be very small
    cells = min(block_cells, max(SMALL_CELLS, -(-sum(counts.values()) // entries.sparkSession.sparkContext.defaultParallelism)))
    blocks = {g: -(-n // cells) for g, n in counts.items()}
    number = F.element_at(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]), F.col(group))
    rows = entries.withColumn("block", F.pmod(F.xxhash64(doc), number).cast("int"))

    def build(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        docs, terms = (t.column(c).combine_chunks().dictionary_encode() for c in (doc, term))
        own, at = (x.indices.to_numpy(zero_copy_only=False) for x in (docs, terms))
        order = np.argsort(own, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(own))]).astype(np.int32)
        n, m = len(ends) - 1, len(terms.dictionary)
        places = pa.concat_arrays([
            pa.ListArray.from_arrays(pa.array(ends), pa.array(at[order].astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32)), pa.array(np.arange(m, dtype=np.int32))),
        ])
        weights = pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(t.column(weight).to_numpy()[order])), pa.nulls(m, pa.list_(pa.float64()))])
        kind = terms.dictionary.type
        return pa.table({
            group: pa.array([key[0].as_py()] * (n + m), t.schema.field(group).type), "block": pa.array([key[1].as_py()] * (n + m), pa.int32()),
            term: pa.concat_arrays([pa.nulls(n, kind), terms.dictionary]), "at": places, "w": weights,
        })

    total = sum(blocks.values())
    dealt = rows.select(group, "block", doc, term, weight).repartition(2 * total, group, "block")
    return _written(dealt.groupBy(group, "block").applyInArrow(build, schema), "lsi-blocks"), total


def _round(group: str, term: str, size: int, chunk: int = 1 << 13):
    """For each block: a row of W = A' Y for each of its terms, and the rows of the R of Y = A Z (with ``line``)."""

    def sums(w: np.ndarray, rows: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The sums of w times ``rows[at]`` between ends, in chunks that stay in the cache."""
        out = np.zeros((len(ends) - 1, size))
        live = np.flatnonzero(np.diff(ends))  # reduceat has no empty sums
        first, a = ends[live], 0
        while a < len(live):
            b = int(np.searchsorted(first, first[a] + chunk))
            lo, hi = first[a], first[b] if b < len(live) else ends[-1]
            out[live[a:b]] = np.add.reduceat(rows[at[lo:hi]] * w[lo:hi, None], first[a:b] - lo)
            a = b
        return out

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        place = left.column("at").to_numpy()
        z = np.zeros((left.num_rows, size))
        z[place] = _vectors(left.column("v").combine_chunks(), size)
        lists = right.column("at").combine_chunks()
        at, w = lists.flatten().to_numpy(), right.column("w").combine_chunks().flatten().to_numpy()
        counts = np.asarray(lists.value_lengths()).astype(np.int64)
        y = sums(w, z, at, np.concatenate([[0], np.cumsum(counts)]))
        order = np.argsort(at, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(z)))])
        out = sums(w[order], y, np.repeat(np.arange(len(y)), counts)[order], ends)[place]
        r = np.linalg.qr(y, mode="r")
        terms = left.column(term).combine_chunks()
        lines = pa.array(key[1].as_py() * size + np.arange(len(r)), pa.int64())
        return pa.table({
            group: pa.array([key[0].as_py()] * (len(out) + len(r)), right.schema.field(group).type),
            term: pa.concat_arrays([terms, pa.nulls(len(r), terms.type)]),
            "line": pa.concat_arrays([pa.nulls(len(out), pa.int64()), lines]), "v": _lists(np.concatenate([out, r])),
        })

    return run


def _product(entries: DataFrame, vectors: DataFrame, group: str, by: str, to: str, size: int, weight: str) -> DataFrame:
    """(group, to, v): for each ``to`` the sum of weight times the vector of ``by``."""
    sums = [F.sum(F.col("v")[i] * F.col(weight)).alias(f"s{i}") for i in range(size)]
    rows = entries.join(vectors, [group, by]).groupBy(group, to).agg(*sums)
    return rows.select(group, to, F.array(*[f"s{i}" for i in range(size)]).alias("v"))


def fit_lsi(
    entries: DataFrame, group: str, doc: str, term: str, weight: str, k: int, oversample: int = 20, tol: float = 1e-7, most_rounds: int = 200, seed: int = 42,
    block_cells: int = 8_000_000,
) -> LsiModel:
    """The ``k`` largest singular values of each corpus and the rows of V for its terms.

    entries: one row (group, doc, term, weight) for each nonzero. Corpora of lower rank have fewer values;
    one without entries isn't in the model. Ends when no value has moved by more than ``tol`` of the largest
    in a round; the rounds' limit raises an error, it doesn't pass off unsettled values as the result. A
    component's entry of largest magnitude is positive (of equal ones the first term's). ``block_cells`` is about
    the most entries of a block (one document is never cut).
    """
    size = k + oversample
    named = entries.select(group, doc, term, F.col(weight).cast("double").alias(weight)).dropna()
    entries = _written(named, "lsi-entries")
    kinds = dict(entries.dtypes)
    two_pi = 2 * np.pi

    def draw(i: int):
        u, w = ((F.pmod(F.xxhash64(F.lit(seed + j), F.lit(i), term), F.lit(1 << 50)) + 1) / F.lit(float((1 << 50) + 2)) for j in (0, 1))
        return F.sqrt(-2 * F.log(u)) * F.cos(w * two_pi)

    blocks, n = _blocks(entries, group, doc, term, weight, block_cells)
    if not n:
        return LsiModel(blocks.select(group, term, F.col("w").alias("v")), group, {})
    # every round reads the documents where they are, in the order of the blocks
    held = blocks.where("w IS NOT NULL").select(group, "block", "at", "w").repartition(2 * n, group, "block").sortWithinPartitions(group, "block").persist(StorageLevel.DISK_ONLY)
    places = _written(blocks.where("w IS NULL").groupBy(group, term).agg(F.collect_list(F.struct("block", F.col("at")[0].alias("at"))).alias("p")), "lsi-places")
    z = places.select(group, term, F.array(*[draw(i) for i in range(size)]).alias("v"))
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(size)]
    schema = f"{group} {kinds[group]}, {term} {kinds[term]}, line bigint, v array<double>"
    last: dict | None = None
    for _ in range(most_rounds):
        sent = z.join(places, [group, term]).select(group, term, "v", F.explode("p").alias("p")).select(group, "p.block", term, "p.at", "v")
        sent = sent.repartition(2 * n, group, "block")
        both = sent.groupBy(group, "block").cogroup(held.groupBy(group, "block")).applyInArrow(_round(group, term, size), schema)
        added = both.groupBy(group, term, "line").agg(*sums)
        out = _written(added.select(group, term, "line", F.array(*[f"s{i}" for i in range(size)]).alias("v")), "lsi-w")
        w = out.where("line IS NULL")
        first, _ = _turns(tree_qr(out.where("line IS NOT NULL"), group, size), size)
        second, values = _turns({g: np.linalg.qr(r @ first[g], mode="r") for g, r in tree_qr(w, group, size).items()}, size)
        z = _turned(w, group, term, size, {g: first[g] @ t for g, t in second.items()})
        moved = max((float(np.abs(v[:k] - last[g][:k]).max() / max(v[0], 1e-300)) for g, v in values.items()), default=0.0) if last is not None else 1.0
        last = values
        if moved <= tol or not values:
            break
    else:
        raise RuntimeError(f"singular values still move by {moved:.1e} of the largest after {most_rounds} rounds")
    held.unpersist()
    kept = {g: [float(x) for x in v[:k] if x > 0] for g, v in last.items()}
    cut = _written(z, "lsi-v")
    top = cut.select(group, term, F.posexplode("v").alias("topic", "x")).where(F.col("topic") < k)
    signs = top.groupBy(group, "topic").agg(F.max_by(F.struct("x"), F.struct(F.abs(F.round("x", 12)), -F.xxhash64(term))).alias("m"))
    sign = {(r[group], r["topic"]): (-1.0 if r["m"]["x"] < 0 else 1.0) for r in signs.collect()}  # k numbers for each corpus
    flips = {g: [sign.get((g, t), 1.0) for t in range(len(s))] for g, s in kept.items()}
    if not flips:
        return LsiModel(cut.select(group, term, "v"), group, {})
    flip = F.element_at(F.create_map(*[x for g, f in flips.items() for x in (F.lit(g), F.array(*[F.lit(y) for y in f]))]), F.col(group))
    rows = cut.select(group, term, F.zip_with(F.slice("v", F.lit(1), F.size(flip)), flip, lambda x, s: x * s).alias("v"))
    return LsiModel(_written(rows, "lsi-v"), group, kept)


def lsi_topics(model: LsiModel, term: str, topn: int = 20) -> DataFrame:
    """(group, topic, rank, term, weight): a component's terms by absolute weight (C4 over LSI)."""
    rows = model.terms.select(model.group, F.col(term).alias("term"), F.posexplode("v").alias("topic", "weight"))
    rank = F.row_number().over(Window.partitionBy(model.group, "topic").orderBy(F.desc(F.abs("weight")), "term"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= topn).select(model.group, "topic", "rank", "term", "weight")


def fold_in(model: LsiModel, entries: DataFrame, doc: str, term: str, weight: str) -> DataFrame:
    """(group, doc, coordinates): documents in the space of the fitted components, ``x V / s``.

    Training documents get their rows of U. Terms that the model lacks are passed over; a document with none
    of its terms gives no row.
    """
    group, size = model.group, max(map(len, model.singular.values()), default=0)
    if not size:
        return entries.select(group, doc, F.array().cast("array<double>").alias("coordinates")).limit(0)
    full = model.terms.select(group, term, F.concat("v", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("v"))).alias("v"))
    found = _product(entries, full, group, term, doc, size, weight)
    s = F.element_at(F.create_map(*[x for g, v in model.singular.items() for x in (F.lit(g), F.array(*[F.lit(y) for y in v]))]), F.col(group))
    return found.select(group, doc, F.zip_with(F.slice("v", F.lit(1), F.size(s)), s, lambda x, y: x / y).alias("coordinates"))


def save_lsi(model: LsiModel, path: str) -> str:
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    rows = [(json.dumps(g), s, model.group) for g, s in model.singular.items()]
    model.terms.sparkSession.createDataFrame(rows, "corpus string, singular array<double>, grouped_by string").write.mode("overwrite").parquet(f"{path}/singular")
    return path


def load_lsi(spark: SparkSession, path: str) -> LsiModel:
    rows = spark.read.parquet(f"{path}/singular").collect()  # a row for each corpus
    return LsiModel(spark.read.parquet(f"{path}/terms"), rows[0]["grouped_by"], {json.loads(r["corpus"]): r["singular"] for r in rows})
