"""Gradient-boosted trees on MLlib: fits, direct horizons, validation and random search."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys
from wattgrid.operators.forecast import fit_seasonal_ar, seasonal_ar_forecast
from wattgrid.operators.metrics import mae
from wattgrid.operators.validation import N_SPLITS, fold_bounds, fold_index
from wattgrid.plans.buckets import attach, row_positions
from wattgrid.session import staged

SEED = 42


@dataclass(frozen=True)
class BoostParams:
    """Tree-boosting settings in MLlib terms."""

    rounds: int = 500
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 5
    max_bins: int = 64
    seed: int = SEED
    tolerance: float = 0.001

    def estimator(self, label: str, validation: str | None = None) -> GBTRegressor:
        made = GBTRegressor(
            featuresCol="features", labelCol=label, predictionCol="y_pred", maxIter=self.rounds, maxDepth=self.depth,
            stepSize=self.rate, subsamplingRate=self.row_share, featureSubsetStrategy=f"{self.column_share:.6f}",
            minInstancesPerNode=self.min_rows, maxBins=self.max_bins, seed=self.seed, validationTol=self.tolerance,
            cacheNodeIds=True, checkpointInterval=10,
        )
        return made.setValidationIndicatorCol(validation) if validation else made


# The tuned configuration of the next-hour model, shared by the day-ahead model.
TUNED = BoostParams(rounds=221, depth=6, rate=0.03567663137948074, row_share=0.8099098641033556, column_share=0.6727299868828402, min_rows=10)
# First-pass configuration used for cross-validation, without early stopping.
CV_PARAMS = BoostParams(rounds=200, depth=6, rate=0.05, row_share=0.8, column_share=0.8, min_rows=5)


def _fit(train: DataFrame, features: Sequence[str], target: str, params: BoostParams, validation: str | None = None) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    typed = train.withColumn(target, F.col(target).cast("double"))
    return Pipeline(stages=[assembler, params.estimator(target, validation)]).fit(typed)


def score(
    model: PipelineModel,
    matrix: DataFrame,
    name: str,
    horizon: str = "h=1",
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
) -> DataFrame:
    """Forecasts of a fitted model as rows of the prediction table."""
    return model.transform(matrix).select(
        *as_keys(keys), F.lit(name).alias("model"), F.lit(horizon).alias("horizon"), ts,
        F.col(target).cast("double").alias("y_true"), "y_pred",
    )


def fit_early_stopping(
    matrix: DataFrame,
    features: Sequence[str],
    target: str = "y",
    val_fraction: float = 0.1,
    params: BoostParams = BoostParams(),
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> PipelineModel:
    """Fit on the training rows; the newest share of each series decides when to stop."""
    train = matrix.where(F.col("split") == "train")
    placed = row_positions(train, keys=keys, ts=ts, step=step, total="__n")
    held_out = F.col("pos") >= F.floor(F.col("__n") * (1 - val_fraction))
    return _fit(placed.withColumn("__validate", held_out).drop("pos", "__n"), features, target, params, "__validate")


def fit_direct(matrix: DataFrame, features: Sequence[str], target: str = "y", params: BoostParams = TUNED) -> PipelineModel:
    """Fit fixed parameters on all training rows, for example of a day-ahead matrix."""
    return _fit(matrix.where(F.col("split") == "train"), features, target, params)


def feature_importances(spark: SparkSession, model: PipelineModel, top: int | None = None) -> DataFrame:
    """``(feature, importance)``, most important first."""
    assembler, trees = model.stages
    rows = [(n, float(v)) for n, v in zip(assembler.getInputCols(), trees.featureImportances.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return table.limit(top) if top else table



def cv_boosted(
    matrix: DataFrame,
    features: Sequence[str],
    target: str = "y",
    n_splits: int = N_SPLITS,
    params: BoostParams = CV_PARAMS,
    name: str = "boosted",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Fold table with validation and training error of one model fitted per fold."""
    names = as_keys(keys)
    tagged = staged(fold_index(matrix.where(F.col("split") == "train"), n_splits, names, ts, step))
    out = None
    for fold in range(1, n_splits + 1):
        began = time.perf_counter()
        model = _fit(tagged.where(F.col("own_fold") < fold), features, target, params)
        seconds = time.perf_counter() - began
        error = F.abs(F.col(target) - F.col("y_pred"))
        scored = model.transform(tagged.where(F.col("own_fold") <= fold)).groupBy(*names).agg(
            F.avg(F.when(F.col("own_fold") == fold, error)).alias("val_mae"),
            F.avg(F.when(F.col("own_fold") < fold, error)).alias("train_mae"),
        )
        row = scored.select(
            *names, F.lit(name).alias("model"), F.lit(fold).alias("fold"), "val_mae", "train_mae",
            F.lit(float(seconds)).alias("fit_seconds"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def cv_seasonal_ar(
    df: DataFrame,
    n_splits: int = N_SPLITS,
    period: int = 24,
    fit_window: int = 90 * 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Fold table of the seasonal autoregression, refitted on the recent rows before each fold."""
    names = as_keys(keys)
    train = df.where(F.col("split") == "train").select(*names, ts, target, "split")
    bounds = fold_bounds(train, n_splits, names, ts, step)
    folds = F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold")
    # The fold joins the key, so all folds of all series are fitted and scored by the same plan.
    marked = attach(train.select("*", folds), bounds, [*names, "fold"]).where(F.col(ts) <= F.col("val_end"))
    staged = marked.withColumn("split", F.when(F.col(ts) < F.col("val_start"), "train").otherwise("test")).select(
        *names, "fold", ts, target, "split"
    )
    grouped = [*names, "fold"]
    fitted = fit_seasonal_ar(staged, period, fit_window, target, grouped, ts, step)
    scored = seasonal_ar_forecast(staged, fitted, period, target, grouped, ts, step)
    return scored.groupBy(*grouped).agg(mae().alias("val_mae")).select(
        *names, F.lit("seasonal_ar").alias("model"), "fold", "val_mae",
        F.lit(None).cast("double").alias("train_mae"), F.lit(None).cast("double").alias("fit_seconds"),
    )


@dataclass
class SearchResult:
    """Outcome of a random search: the refitted best model and the score of every candidate."""

    model: PipelineModel
    params: BoostParams
    cv_mae: float
    candidates: list[tuple[BoostParams, float]] = field(default_factory=list)


def draw_params(n: int, seed: int = SEED, rounds: tuple[int, int] = (200, 1000)) -> list[BoostParams]:
    """Reproducible random candidates over the search ranges."""
    rng = np.random.default_rng(seed)
    return [
        BoostParams(
            rounds=int(rng.integers(*rounds)), depth=int(rng.integers(3, 9)), rate=float(rng.uniform(0.01, 0.15)),
            row_share=float(rng.uniform(0.6, 1.0)), column_share=float(rng.uniform(0.6, 1.0)),
            min_rows=int(rng.integers(1, 11)), seed=seed,
        )
        for _ in range(n)
    ]


def random_search(
    matrix: DataFrame,
    features: Sequence[str],
    candidates: Sequence[BoostParams],
    target: str = "y",
    n_splits: int = N_SPLITS,
    parallelism: int = 4,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> SearchResult:
    """Expanding-window score of every candidate (mean over folds), best refitted on all training rows.

    Candidate x fold fits are independent Spark jobs submitted from a few driver threads.
    """
    names = as_keys(keys)
    train = matrix.where(F.col("split") == "train")
    tagged = staged(fold_index(train, n_splits, names, ts, step))

    def one(job: tuple[int, int]) -> tuple[int, float]:
        index, fold = job
        model = _fit(tagged.where(F.col("own_fold") < fold), features, target, candidates[index])
        found = model.transform(tagged.where(F.col("own_fold") == fold)).agg(mae(target, "y_pred").alias("m")).first()
        return index, float(found["m"])

    jobs = [(i, f) for i in range(len(candidates)) for f in range(1, n_splits + 1)]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(one, jobs))
    means = [float(np.mean([s for i, s in scores if i == c])) for c in range(len(candidates))]
    best = int(np.argmin(means))
    return SearchResult(_fit(train, features, target, candidates[best]), candidates[best], means[best], list(zip(candidates, means)))


def comparison(spark: SparkSession, scores: Mapping[str, float]) -> DataFrame:
    """``(model, cv_mae)`` rows for the tuned-versus-untuned verdict."""
    return spark.createDataFrame([(n, float(v)) for n, v in scores.items()], "model string, cv_mae double")
