"""Language identification: nearest of several centroids per language by cosine.

Texts become normalised TF-IDF vectors of hashed character n-grams. Document frequencies come from all
learning documents; the centroids of a language come from spherical k-means over a bounded sample of
its documents (about ``SAMPLE_ROWS`` per language, chosen by a hash of the text). A text whose nearest
centroid is farther than ``max_distance`` is rejected.

A NULL text and a text without any letter are ``und`` with score 0. Learning leaves out rows with a
NULL language or text; without any learned language every text is ``und``. Repeated rows weigh as often
as they occur. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrid.llm import ngrams

ORDERS = range(1, 4)
BITS = 13
CENTROIDS = 3
SAMPLE_ROWS = 1000
ITERATIONS = 12
MAX_DISTANCE = 0.85
UNDETERMINED = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Languages by centroid row, the centroids (unit length) and the inverse document frequencies."""

    langs: list[str]
    centroids: np.ndarray
    idf: np.ndarray


def fold(id_col: Column) -> Column:
    """The remainder that decides who learns: crc32 of the id as text, modulo 5 (NULL as '')."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(5))


def has_letter(text: str | None) -> bool:
    return text is not None and next(filter(str.isalpha, text), None) is not None


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs; runs of non-letters count as one blank."""
    found = ngrams.buckets(ngrams.code_points(_NO_LETTERS.sub(" ", text)), ORDERS, BITS)
    return np.bincount(np.concatenate(found), minlength=1 << BITS)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vector of a whole text."""
    v = np.log1p(counts(text)) * idf
    length = float(np.sqrt(v @ v))
    return v / length if length else v


def _learners(documents: DataFrame) -> DataFrame:
    rows = documents.select(F.col("text"), F.col("lang"), F.col("doc_id").alias("i"))
    return rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("i")) != 0)).select("text", "lang")


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            seen += counts(text.as_py()) > 0
            n += 1
    at = np.append(np.flatnonzero(seen), -1)
    yield pa.record_batch([pa.array(at), pa.array(np.append(seen[at[:-1]], n))], names=["bucket", "n"])


def _idf(learners: DataFrame) -> np.ndarray:
    rows = learners.mapInArrow(_document_frequencies, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = dict(rows.toPandas().itertuples(index=False, name=None))  # at most 2 ** BITS + 1 rows
    total, seen = found.pop(-1, 0), np.zeros(1 << BITS)
    for bucket, n in found.items():
        seen[bucket] = n
    return np.log((1 + total) / (1 + seen))


def _sample(learners: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` documents of each language (all of a language with fewer), by a hash of the text.
    The shares are broadcast, so that no text moves before it is drawn; they are far smaller than the
    model, which holds several vectors for each language and goes to every task as well."""
    share = learners.groupBy("lang").agg((F.lit(float(rows)) / F.count("*")).alias("share"))
    drawn = F.pmod(F.xxhash64("text", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    return learners.withColumn("drawn", drawn).join(F.broadcast(share), "lang").where(F.col("drawn") < F.col("share")).select("lang", "text")


def spherical_kmeans(points: np.ndarray, k: int, iterations: int = ITERATIONS) -> np.ndarray:
    """At most k unit centroids; starts from the mean's nearest point, then from the farthest ones."""
    mean = points.mean(axis=0)
    chosen = [int(np.argmax(points @ mean))]
    near = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, points @ points[chosen[-1]])
    centroids = points[chosen]
    for _ in range(iterations):
        owner = np.argmax(points @ centroids.T, axis=1)
        sums = np.stack([points[owner == j].sum(axis=0) if (owner == j).any() else centroids[j] for j in range(len(centroids))])
        moved = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    return centroids


def fit(documents: DataFrame, k: int = CENTROIDS, rows: int = SAMPLE_ROWS) -> Model:
    """Learn document frequencies from all learning rows and centroids from a sample of each language."""
    learners = _learners(documents)
    idf = _idf(learners)
    shared = documents.sparkSession.sparkContext.broadcast(idf)

    def cluster(key: tuple, table: pa.Table) -> pa.Table:
        texts = sorted(t for t in table["text"].to_pylist() if has_letter(t))
        points = np.stack([vector(t, shared.value) for t in texts]) if texts else np.zeros((0, 1 << BITS))
        points = points[np.abs(points).sum(axis=1) > 0].astype(np.float32)
        found = spherical_kmeans(points, k) if len(points) else points
        return pa.table({"lang": pa.array([key[0].as_py()] * len(found), pa.string()), "centroid": pa.array([c.astype(np.float32).tobytes() for c in found], pa.binary())})

    rows_ = _sample(learners, rows).groupBy("lang").applyInArrow(cluster, "lang string, centroid binary").collect()
    rows_.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = [np.frombuffer(r["centroid"], np.float32).astype(float) for r in rows_]
    return Model([r["lang"] for r in rows_], np.stack(centroids) if centroids else np.zeros((0, 1 << BITS)), idf)


def predict(documents: DataFrame, model: Model, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for each document row. ``lang_pred`` is the
    nearest language; ``rejected`` tells that even it is farther than ``max_distance``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang string, score double")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value

        def one(text: str | None) -> dict:
            if not has_letter(text) or not model.langs:
                return {"lang": UNDETERMINED, "score": 0.0}
            cosines = model.centroids @ vector(text, model.idf)
            best = int(np.argmax(cosines))
            return {"lang": model.langs[best], "score": float(min(max(cosines[best], 0.0), 1.0))}

        for texts in batches:
            yield pa.array([one(t.as_py()) for t in texts], kind)

    rows = documents.select(F.col("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), nearest(F.col("text")).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), (1 - F.col("p.score") > max_distance).alias("rejected"))
