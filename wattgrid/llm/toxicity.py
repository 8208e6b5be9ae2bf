"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct hashed n-grams of ``ORDERS`` characters. Each is scaled by
``r = log((1 + p) / (1 + q))``-style log-count ratios of the labelled texts; n-grams that speak clearly
for label 1 (``r >= LEAST_RATIO``, in at least ``LEAST_TEXTS`` texts) are kept, and a regularised
logistic regression is trained on the scaled features. The fit uses a bounded sample of labelled rows
(``SAMPLE_ROWS``, smallest hash of the id first); scoring reads every whole text, without a shuffle.

NULL and empty texts have no features and get the score of the intercept. Rows with a NULL label or a
label other than 0 and 1 are not learned from; a repeated label row counts once, and a document with
both labels gives one example of each. Without any labelled row each score is 0.5. Extra columns of
the tables are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrid.llm import ngrams
from wattgrid.session import staged

ORDERS = range(4, 8)
BITS = 20
SAMPLE_ROWS = 20_000
SAMPLE_TASKS = 8
LEAST_RATIO = 1.5
LEAST_TEXTS = 4
SMOOTHING = 0.5
PENALTY = 1e-3
ROUNDS = 80
THRESHOLD = 0.3


def features(text: str | None) -> np.ndarray:
    """The distinct n-gram buckets of a whole text."""
    found = ngrams.buckets(ngrams.code_points(text or ""), ORDERS, BITS)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


@dataclass(frozen=True)
class Model:
    """Kept buckets (sorted), their weights (ratio times coefficient) and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def fold(id_col: Column) -> Column:
    """The remainder that decides who learns: crc32 of the id as text, modulo 4 (NULL as '')."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(4))


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").alias("i"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("i").isNotNull() & (fold(F.col("i")) != 2))
        .distinct()
    )
    chosen = known.orderBy(F.xxhash64("i"), "label").limit(rows)  # at most `rows` pairs of numbers
    texts = documents.select(F.col("doc_id").alias("i"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "i").select("text", "label").repartition(SAMPLE_TASKS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            counts[label.as_py()][features(text.as_py())] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    for part in np.array_split(seen, max(1, len(seen) // 50_000)):
        yield pa.record_batch([pa.array(part), pa.array(counts[1, part]), pa.array(counts[0, part])], names=["bucket", "p", "q"])


def _kept(sample: DataFrame, totals: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that speak for label 1 and their log-count ratios (at most ``2 ** BITS`` rows)."""
    base = np.log((totals.get(1, 0) + 2 * SMOOTHING) / (totals.get(0, 0) + 2 * SMOOTHING))
    counted = sample.mapInArrow(_count, "bucket bigint, p bigint, q bigint").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    ratio = F.log((F.col("p") + SMOOTHING) / (F.col("q") + SMOOTHING)) - F.lit(float(base))
    rows = counted.select("bucket", ratio.alias("r"), (F.col("p") + F.col("q")).alias("n")).where((F.col("r") >= LEAST_RATIO) & (F.col("n") >= LEAST_TEXTS))
    frame = rows.toPandas().sort_values("bucket")
    return frame["bucket"].to_numpy(np.uint32), frame["r"].to_numpy(np.float64)


def _placed(ids: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Positions in ``kept`` of the ids that it holds."""
    if not len(kept):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(kept, ids), len(kept) - 1)
    return at[kept[at] == ids]


def _examples(sample: DataFrame, kept: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and kept features of the sample rows; bounded by the sample and by 2 ** BITS."""
    shared = sample.sparkSession.sparkContext.broadcast(kept)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [_placed(features(t.as_py()), shared.value).astype(np.int32).tobytes() for t in batch["text"]]
            yield pa.record_batch([batch["label"], pa.array(at, pa.binary())], names=["label", "at"])

    table = sample.mapInArrow(place, "label int, at binary").toArrow()
    return table["label"].to_numpy().astype(float), [np.frombuffer(b.as_py(), np.int32) for b in table["at"]]


def _train(labels: np.ndarray, at: list[np.ndarray], ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled binary features, full-batch steps with adaptive rates."""
    order = sorted(range(len(at)), key=lambda i: (labels[i], at[i].tobytes()))  # rows arrive in any order
    labels, at = labels[order], [at[i] for i in order]
    row, col = np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate(at)
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    w, b = np.zeros(len(ratios)), float(np.log(rate / (1 - rate)))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, ROUNDS + 1):
        z = np.bincount(row, (w * ratios)[col], len(at)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        slope = np.bincount(col, error[row], len(w)) * ratios / len(at) + PENALTY * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w = w - 0.02 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
        b -= 0.3 * float(error.mean())
    return w * ratios, b


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Train on a bounded sample of labelled documents."""
    sample = staged(labelled_sample(documents, labels, rows))
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not totals:
        return Model(np.zeros(0, np.uint32), np.zeros(0), 0.0)
    kept, ratios = _kept(sample, totals)
    target, at = _examples(sample, kept)
    weights, intercept = _train(target, at, ratios)
    return Model(kept, weights, intercept)


def scorer(spark: SparkSession, model: Model):
    """A column function: text to the probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        dense = np.zeros(1 << BITS)
        dense[model.buckets] = model.weights
        held = np.zeros(1 << BITS, bool)
        held[model.buckets] = True

        def one(text: str | None) -> float:
            found = [ids[held[ids]] for ids in ngrams.buckets(ngrams.code_points(text or ""), ORDERS, BITS)]
            z = model.intercept + (float(dense[np.unique(np.concatenate(found))].sum()) if found else 0.0)
            return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))

        for texts in batches:
            yield pa.array([one(t.as_py()) for t in texts], pa.float64())

    return score


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document row."""
    likely = scorer(documents.sparkSession, model)
    rows = documents.select(F.col("doc_id"), (fold(F.col("doc_id")) == 2).alias("held_out"), likely(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def remove(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    return documents.where(scorer(documents.sparkSession, model)(F.col("text")) < threshold)
