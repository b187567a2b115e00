"""Language ID: nearest of several centroids per language over TF-IDF vectors of character n-grams.

Features: the text in lower case, runs of non-letters as one space; its character 1-, 2- and 3-grams are
hashed into ``DIMS`` buckets, counts enter as square roots, times idf, scaled to length 1.

Fit: a sample of at most about ``fit_rows`` labelled rows, the same share of every language that has
more than its part (rows below a threshold of a content hash, so the bound needs no sort). Idf and
centroids come from that sample only; k-means with cosine clusters each language into ``clusters``
centroids. The driver holds the sample's vectors (``fit_rows x DIMS`` floats at most) and the centroids.

Predict: one pass over all rows, no shuffle; the language of the nearest centroid by cosine. A text is
rejected when it lies farther from its centroid than the sample's own texts of about its length nearly
ever do: the ``1 - reject_quantile`` quantile of distances by length in letters, widened by
``reject_slack``, learned from pieces of the sample's texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.registry import query, table
from revlens.llm.textcodes import character_table, code_points, mix, text_slabs

DIMS = 4096
UNKNOWN = "und"
LENGTH_BINS = 16


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of n-gram bucket counts (texts x DIMS), and letters per text."""
    codes, ends = code_points([t.lower() for t in texts])
    letter = character_table("alpha")[codes]
    row = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=-1))
    letters = np.bincount(row[letter], minlength=len(texts))
    # one space for each run of other characters, and around each text
    keep = letter | np.append(True, letter[:-1])
    keep[ends] = True
    c, row = np.where(letter, codes, 32)[keep].astype(np.uint64), row[keep]
    # a text's last space stands before the next text's first letter as well
    grams = []
    for n in (1, 2, 3):
        h = np.full(max(0, len(c) - n + 1), np.uint64(n))
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + c[k : len(c) - n + 1 + k]
        same = row[: len(h)] == row[n - 1 : n - 1 + len(h)]
        if n == 1:
            same &= c != 32
        grams.append(row[: len(h)][same] * DIMS + (mix(h[same]) >> np.uint64(52)).astype(np.int64))
    counts = np.bincount(np.concatenate(grams), minlength=len(texts) * DIMS).reshape(len(texts), DIMS)
    return np.sqrt(counts, dtype=np.float32), letters


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def cosine_kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 15) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows; far points seed first, empty clusters are dropped."""
    centers = [x[int(rng.integers(len(x)))]]
    for _ in range(min(k, len(x)) - 1):
        gap = np.maximum(1 - np.max(x @ np.array(centers).T, axis=1), 0) ** 2
        if gap.sum() <= 1e-9:
            break
        centers.append(x[int(rng.choice(len(x), p=gap / gap.sum()))])
    c = np.array(centers)
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        c = unit(np.array([x[near == j].sum(0) for j in range(len(c)) if (near == j).any()]))
    return c


@dataclass
class CentroidModel:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]  # of each centroid
    floor: np.ndarray  # least cosine kept, by length bin

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine to its nearest centroid (0 to 1) and whether the text is rejected."""
        x, letters = vectors(texts)
        sims = unit(x * self.idf) @ self.centroids.T
        near = np.argmax(sims, axis=1)
        best = np.clip(sims[np.arange(len(near)), near].astype(float), 0.0, 1.0)
        return [self.languages[j] for j in near], best, best < self.floor[length_bin(letters)]


def length_bin(letters: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(letters, 1)).astype(int), 0, LENGTH_BINS - 1)


def pieces_by_length(texts: list[str], rng: np.random.Generator, per_bin: int = 400) -> list[list[str]]:
    """For each length bin, pieces of the texts of about that many characters."""
    out = []
    for b in range(LENGTH_BINS):
        n = 2**b + 2 ** max(0, b - 1)
        fits = [t for t in texts if len(t) >= n]
        chosen = rng.choice(len(fits), min(per_bin, len(fits)), replace=False) if fits else []
        spots = [(fits[i], int(rng.integers(len(fits[i]) - n + 1))) for i in chosen]
        out.append([t[s : s + n] for t, s in spots])
    return out


def fit_centroids(texts: list[str], langs: list[str], clusters: int, reject_quantile: float, reject_slack: float, seed: int) -> CentroidModel:
    """Model of a bounded sample in memory."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([vectors(texts[lo:hi])[0] for lo, hi in text_slabs(texts)])
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x = unit(x * idf)
    lang = np.array(langs)
    centroids, names = [], []
    for one in sorted(set(langs)):
        c = cosine_kmeans(x[lang == one], clusters, rng)
        centroids.append(c)
        names += [one] * len(c)
    model = CentroidModel(idf, np.concatenate(centroids), names, np.zeros(LENGTH_BINS))
    floor = np.zeros(LENGTH_BINS)
    for b, pieces in enumerate(pieces_by_length(texts, rng)):
        if len(pieces) >= 50:
            floor[b] = reject_slack * np.quantile(model.score(pieces)[1], reject_quantile)
        elif b:
            floor[b] = floor[b - 1]
    model.floor = floor
    return model


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fit_rows: int = 4000,
    clusters: int = 4,
    reject_quantile: float = 0.001,
    reject_slack: float = 0.6,
    seed: int = 0,
) -> CentroidModel | None:
    """Fit on about ``fit_rows`` of the labelled rows of ``docs``; None if there are none with a letter.

    Rows with a null label, null text or no letter are not learned from. At most 1000 languages.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counted = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(1000).collect()}
    if not counted:
        return None
    part = max(1, fit_rows // len(counted))
    share = F.create_map(*[F.lit(v) for k, n in counted.items() for v in (k, min(1.0, part / n))])
    drawn = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1 << 32)) < F.element_at(share, F.col("lang")) * float(1 << 32)
    sample = sorted((r["lang"], r["text"]) for r in rows.where(F.col("lang").isin(list(counted)) & drawn).collect())
    if not sample:
        sample = sorted((r["lang"], r["text"]) for r in rows.orderBy(F.xxhash64("id", "text", F.lit(seed))).limit(fit_rows).collect())
    return fit_centroids([t for _, t in sample], [k for k, _ in sample], clusters, reject_quantile, reject_slack, seed)


def predict(docs: DataFrame, model: CentroidModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (columns of these names are replaced).

    A null text, and one without any letter, is ``und`` with score 0 and rejected; so is every text
    without a model. A text that is rejected by distance keeps the nearest language in ``lang_pred``.
    Nulls elsewhere pass through; repeated rows get equal results; texts are read whole.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    src = docs.select(*[F.col(f"`{c}`") for c in kept])
    spot = kept.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            texts = b.column(spot).to_pylist()
            for lo, hi in text_slabs(texts, 1 << 20):
                for a in range(lo, hi, 512):
                    part = texts[a : min(a + 512, hi)]
                    pred, score, out = [UNKNOWN] * len(part), np.zeros(len(part)), np.ones(len(part), bool)
                    known = [i for i, t in enumerate(part) if model is not None and t is not None and any(map(str.isalpha, t))]
                    if known:
                        names, score[known], out[known] = model.score([part[i] for i in known])
                        for i, name in zip(known, names, strict=True):
                            pred[i] = name
                    cols = [*b.slice(a, len(part)).columns, pa.array(pred, pa.string()), pa.array(score), pa.array(out)]
                    yield pa.RecordBatch.from_arrays(cols, [*kept, "lang_pred", "score", "rejected"])

    added = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    schema = T.StructType(src.schema.fields + added.fields)
    return src.mapInArrow(run, schema)


def remainder(id_col: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def identify(docs: DataFrame, **how) -> DataFrame:
    """Fit on the rows whose id has a remainder other than 1 modulo 3, predict all rows."""
    learn = docs.where(remainder("doc_id", 3) != 1)
    return predict(docs, fit(learn, **how))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder("doc_id", 3) != 1))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )
