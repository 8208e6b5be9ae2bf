"""Forecast errors, leaderboards and error breakdowns on the long prediction table.

The table is ``(keys..., model, horizon, ts, y_true, y_pred)``. Rows with a NULL on either side are
left out of every mean and reported as ``n_null``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys, calendar_part
from wattgrid.operators.features import rolling_columns, seasonal_difference
from wattgrid.plans.buckets import attach, over_neighbours

METRICS = ["mae", "rmse", "mape", "smape", "mase"]
SEASONAL_PERIOD = 24


def _pair(y_true: str, y_pred: str) -> tuple[Column, Column]:
    both = F.col(y_true).isNotNull() & F.col(y_pred).isNotNull()
    return F.when(both, F.col(y_true).cast("double")), F.when(both, F.col(y_pred).cast("double"))


def mae(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    """Mean absolute error."""
    t, p = _pair(y_true, y_pred)
    return F.avg(F.abs(t - p))


def rmse(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    """Root mean squared error."""
    t, p = _pair(y_true, y_pred)
    return F.sqrt(F.avg((t - p) * (t - p)))


def mape(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    """Mean absolute percentage error over rows with a non-zero truth; NULL if there are none."""
    t, p = _pair(y_true, y_pred)
    return F.avg(F.when(t != 0, F.abs((t - p) / t))) * 100


def smape(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    """Symmetric percentage error; two zeros count as no error."""
    t, p = _pair(y_true, y_pred)
    size = F.abs(t) + F.abs(p)
    term = F.when(size != 0, F.abs(t - p) * 2 / size).when(size == 0, F.lit(0.0))
    return F.avg(term) * 100


def seasonal_naive_scale(
    train: DataFrame,
    period: int = SEASONAL_PERIOD,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
    gaps: str = "rows",
) -> DataFrame:
    """Mean absolute seasonal difference of the training target: ``(keys, scale)``. Training rows may have
    been dropped, so the period counts rows."""
    names = as_keys(keys)
    slim = train.select(*names, ts, F.col(target).cast("double").alias(target))
    diffs = seasonal_difference(slim, period, target, "__d", names, ts, step, rows, gaps)
    return diffs.groupBy(*names).agg(F.avg(F.abs("__d")).alias("scale"))


def mase(mae_value: Column, scale: Column) -> Column:
    """Error relative to the seasonal naive forecast; NULL when the scale is 0."""
    return mae_value / F.nullif(scale, F.lit(0.0))


def evaluate(
    predictions: DataFrame,
    scale: DataFrame | float | None = None,
    by: Sequence[str] = ("series_id", "model", "horizon"),
    keys: str | Sequence[str] = "series_id",
) -> DataFrame:
    """All five metrics per group in one aggregation.

    ``scale`` is a table ``(keys, scale)``, one number for all, or absent (MASE is then NULL).
    """
    missing = F.col("y_true").isNull() | F.col("y_pred").isNull()
    scores = predictions.groupBy(*by).agg(
        F.count_if(~missing).alias("n"),
        F.count_if(missing).alias("n_null"),
        mae().alias("mae"),
        rmse().alias("rmse"),
        mape().alias("mape"),
        smape().alias("smape"),
    )
    if isinstance(scale, DataFrame):
        scores = scores.join(scale.select(*as_keys(keys), "scale"), as_keys(keys), "left")
    else:
        scores = scores.withColumn("scale", F.lit(scale).cast("double"))
    return scores.withColumn("mase", mase(F.col("mae"), F.col("scale"))).drop("scale")


def leaderboard(
    predictions: DataFrame,
    scale: DataFrame | float | None = None,
    keys: str | Sequence[str] = "series_id",
    order: Sequence[str] = ("horizon", "mae"),
    ranked: bool = False,
) -> DataFrame:
    """Metrics per model, best first inside each horizon label."""
    names = as_keys(keys)
    board = evaluate(predictions, scale, [*names, "model", "horizon"], names)
    if ranked:
        within = Window.partitionBy(*names, "horizon").orderBy("mae", "model")
        board = board.withColumn("rank", F.row_number().over(within))
    return board.orderBy(*names, *order, "model")


def sort_leaderboard(board: DataFrame, metric: str, keys: str | Sequence[str] = ()) -> DataFrame:
    """The leaderboard ordered by any of the five metrics."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {METRICS}")
    return board.orderBy(*as_keys(keys), metric, "model")


def error_breakdown(
    predictions: DataFrame, attribute: str = "hour", by: Sequence[str] = ("series_id", "model"), ts: str = "ts"
) -> DataFrame:
    """MAE by hour, day of week or month."""
    return predictions.groupBy(*by, calendar_part(attribute, ts).cast("bigint").alias(attribute)).agg(mae().alias("mae"))


def error_breakdowns(
    predictions: DataFrame,
    attributes: Sequence[str] = ("hour", "dayofweek", "month"),
    by: Sequence[str] = ("series_id", "model"),
    ts: str = "ts",
) -> DataFrame:
    """Several breakdowns in one scan: ``(by..., attribute, level, mae)``.

    Rows are first summed per combination of all attributes (a bounded calendar grid), so each
    input row is aggregated once and only the small grid is regrouped.
    """
    t, p = _pair("y_true", "y_pred")
    parts = [calendar_part(a, ts).cast("bigint").alias(a) for a in attributes]
    grid = predictions.groupBy(*by, *parts).agg(F.sum(F.abs(t - p)).alias("__sum"), F.count(t - p).alias("__n"))
    long = grid.select(
        *by,
        "__sum",
        "__n",
        F.inline(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("level")) for a in attributes])),
    )
    return long.groupBy(*by, "attribute", "level").agg(
        (F.sum("__sum") / F.nullif(F.sum("__n"), F.lit(0))).alias("mae")
    )


def error_side_by_side(
    predictions: DataFrame, models: Sequence[str], attribute: str, by: Sequence[str] = ("series_id",), ts: str = "ts"
) -> DataFrame:
    """One MAE column per model, one row per calendar level."""
    level = calendar_part(attribute, ts).cast("bigint").alias(attribute)
    rows = predictions.where(F.col("model").isin(list(models)))
    return rows.groupBy(*by, level).agg(
        *[F.avg(F.when(F.col("model") == m, F.abs(F.col("y_true") - F.col("y_pred")))).alias(m) for m in models]
    )


def worst_levels(breakdown: DataFrame, attribute: str, k: int = 4, value: str = "mae") -> DataFrame:
    """The ``k`` levels with the largest error."""
    return breakdown.orderBy(F.desc(value), attribute).limit(k)


def pick_levels(breakdown: DataFrame, attribute: str, levels: Sequence[int]) -> DataFrame:
    """Only the named levels, for example a good and a bad month."""
    return breakdown.where(F.col(attribute).isin(list(levels)))


def residuals(predictions: DataFrame) -> DataFrame:
    """``y_true - y_pred`` where both exist."""
    return predictions.withColumn("residual", F.col("y_true") - F.col("y_pred")).where(F.col("residual").isNotNull())


def cv_summary(folds: DataFrame, keys: str | Sequence[str] = "series_id") -> DataFrame:
    """Mean and population deviation of the fold errors, train gap and fit time, best first.

    ``folds`` is ``(keys, model, fold, val_mae, train_mae, fit_seconds)``.
    """
    names = as_keys(keys)
    return (
        folds.groupBy(*names, "model")
        .agg(
            F.count(F.lit(1)).alias("n_folds"),
            F.avg("val_mae").alias("cv_mae_mean"),
            F.stddev_pop("val_mae").alias("cv_mae_std"),
            (F.avg("val_mae") - F.avg("train_mae")).alias("train_vs_cv_gap"),
            F.avg("fit_seconds").alias("fit_seconds_mean"),
        )
        .orderBy(*names, "cv_mae_mean", "model")
    )


def cv_winner(summary: DataFrame, keys: str | Sequence[str] = "series_id") -> DataFrame:
    """The model with the lowest mean fold error per series; equal errors go to the first name."""
    ordered = F.struct(F.col("cv_mae_mean"), F.col("model"))
    best = summary.groupBy(*as_keys(keys)).agg(F.min(ordered).alias("__best"))
    return best.select(*as_keys(keys), F.col("__best.model").alias("winner"), F.col("__best.cv_mae_mean").alias("cv_mae"))


def rolling_errors(
    predictions: DataFrame,
    window: int,
    scale: DataFrame | float | None = None,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    gaps: str = "rows",
) -> DataFrame:
    """MAE and MASE over the last ``window`` predictions, per series and model; hours without a
    prediction do not count unless ``gaps='fail'`` forbids them."""
    names = as_keys(keys)
    errors = predictions.select(*names, "model", ts, F.abs(F.col("y_true") - F.col("y_pred")).alias("__err"))
    rolled = over_neighbours(
        errors,
        lambda d, over: rolling_columns(d, over, [window], "__err", shift=0, prefix="__r"),
        keys=[*names, "model"], ts=ts, step=step, before=window, gaps=gaps,
    ).select(*names, "model", ts, F.col(f"__r_mean_{window}").alias("rolling_mae"))
    if isinstance(scale, DataFrame):
        rolled = attach(rolled, scale.select(*names, "scale"), names)
    else:
        rolled = rolled.withColumn("scale", F.lit(scale).cast("double"))
    return rolled.withColumn("rolling_mase", mase(F.col("rolling_mae"), F.col("scale"))).drop("scale")
