"""Expanding-window validation on the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys
from wattgrid.operators.metrics import mae
from wattgrid.plans.buckets import row_positions

N_SPLITS = 5


def _placed(df: DataFrame, n_splits: int, names: list[str], ts: str, step: int) -> DataFrame:
    """Position, fold size and first validation row of every series."""
    numbered = row_positions(df, keys=names, ts=ts, step=step, total="__n")
    size = F.floor(F.col("__n") / (n_splits + 1)).cast("bigint")
    return numbered.withColumn("__size", size).withColumn("__head", F.col("__n") - F.col("__size") * n_splits)


def fold_index(
    train: DataFrame,
    n_splits: int = N_SPLITS,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Add ``own_fold``: the fold 1..n_splits a row validates, 0 for the rows before all of them.

    Fold f validates on ``own_fold = f`` and trains on ``own_fold < f``. Series shorter than
    ``n_splits + 1`` rows have no folds and are left out.
    """
    placed = _placed(train, n_splits, as_keys(keys), ts, step).where(F.col("__size") > 0)
    inside = F.col("pos") >= F.col("__head")
    fold = F.floor((F.col("pos") - F.col("__head")) / F.col("__size")) + 1
    return placed.withColumn("own_fold", F.when(inside, fold).otherwise(F.lit(0)).cast("int")).drop(
        "__n", "__size", "__head", "pos"
    )


def validation_folds(
    train: DataFrame,
    n_splits: int = N_SPLITS,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Rows of the validation parts with their ``fold``; a row validates at most once."""
    return fold_index(train, n_splits, keys, ts, step).where(F.col("own_fold") > 0).withColumnRenamed("own_fold", "fold")


def expanding_folds(
    train: DataFrame,
    n_splits: int = N_SPLITS,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """One row per fold and role: everything before a fold's validation part is its training part."""
    roles = F.expr(
        f"""transform(sequence(greatest(own_fold, 1), {n_splits}),
            f -> named_struct('fold', f, 'role', if(f = own_fold, 'val', 'train')))"""
    )
    return fold_index(train, n_splits, keys, ts, step).select("*", F.inline(roles)).drop("own_fold")


def fold_bounds(
    train: DataFrame,
    n_splits: int = N_SPLITS,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """First and last timestamp and size of every validation part."""
    folds = validation_folds(train, n_splits, keys, ts, step)
    return folds.groupBy(*as_keys(keys), "fold").agg(
        F.min(ts).alias("val_start"), F.max(ts).alias("val_end"), F.count(F.lit(1)).alias("n_val")
    )


def cv_naive(
    train: DataFrame,
    lags: Sequence[int] = (1, 24, 168),
    n_splits: int = N_SPLITS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Fold errors of the naive forecasts, all lags in one job: ``(keys, model, fold, val_mae, ...)``."""
    names = as_keys(keys)
    slim = train.select(*names, ts, target, *[f"lag_{k}" for k in lags])
    folds = validation_folds(slim, n_splits, names, ts, step)
    models = F.inline(F.array(*[
        F.struct(F.lit(f"naive_lag{k}").alias("model"), F.col(f"lag_{k}").alias("y_pred")) for k in lags
    ]))
    long = folds.select(*names, "fold", F.col(target).alias("y_true"), models)
    return long.groupBy(*names, "model", "fold").agg(
        mae().alias("val_mae"),
        F.lit(None).cast("double").alias("train_mae"),
        F.lit(None).cast("double").alias("fit_seconds"),
    )
