"""Forecasts that are plain DataFrame expressions: seasonal naive and seasonal autoregression."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys, lit_ts, naive, plus_seconds, quoted, seconds_between
from wattgrid.operators.features import recent_tail
from wattgrid.plans.buckets import BUCKET, BUCKET_ROWS, attach, bucket_of, over_neighbours

NAIVE_LAGS = [1, 24, 168]
FIT_WINDOW = 90 * 24


def naive_forecasts(
    features: DataFrame,
    lags: Sequence[int] = NAIVE_LAGS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    horizon: str = "h=1",
) -> DataFrame:
    """The value ``lag`` steps earlier as forecast of every test row, one model per lag."""
    test = features.where(F.col("split") == "test")
    made = F.inline(F.array(*[
        F.struct(F.lit(f"naive_lag{k}").alias("model"), F.col(f"lag_{k}").cast("double").alias("y_pred")) for k in lags
    ]))
    wide = test.select(*as_keys(keys), ts, F.col(target).cast("double").alias("y_true"), made)
    return wide.select(*as_keys(keys), "model", F.lit(horizon).alias("horizon"), ts, "y_true", "y_pred")


def align_predictions(
    truth: DataFrame, forecast: DataFrame, keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """Attach ``y_pred`` to the truth's timestamps; truth rows without a forecast keep NULL."""
    names = as_keys(keys)
    return truth.join(forecast.select(*names, ts, "y_pred"), [*names, ts], "left")


def _seasonal_terms(
    df: DataFrame, period: int, target: str, names: list[str], ts: str, step: int, rows: int | None, gaps: str
) -> DataFrame:
    """Seasonal difference ``d`` and its lags 1, period, period + 1, with the seasonal base."""
    def build(d: DataFrame, over: str) -> DataFrame:
        def y(k: int) -> str:
            return f"lag({quoted(target)}, {k}) OVER ({over})"

        p = period
        return d.selectExpr(
            "*",
            f"{y(p)} AS base",
            f"{quoted(target)} - {y(p)} AS d",
            f"{y(1)} - {y(p + 1)} AS d1",
            f"{y(p)} - {y(2 * p)} AS d2",
            f"{y(p + 1)} - {y(2 * p + 1)} AS d3",
        )

    slim = df.select(*names, ts, F.col(target).cast("double").alias(target), "split")
    return over_neighbours(slim, build, keys=names, ts=ts, step=step, before=2 * period + 1, rows=rows, gaps=gaps)


_TERMS = ["one", "d1", "d2", "d3"]


def _solve(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Normal equations of many series at once; a singular system takes the least-norm solution."""
    k = len(_TERMS)
    for batch in batches:
        gram = np.empty((len(batch), k, k))
        right = np.empty((len(batch), k))
        for i in range(k):
            right[:, i] = batch[f"r{i}"]
            for j in range(k):
                gram[:, i, j] = batch[f"g{min(i, j)}{max(i, j)}"]
        solved = np.einsum("nij,nj->ni", np.linalg.pinv(gram, hermitian=True), right)
        out = batch[names].copy()
        for i, term in enumerate(_TERMS):
            out[f"b_{term}"] = solved[:, i]
        out["n_fit"] = batch["n_fit"].to_numpy()
        yield out


def fit_seasonal_ar(
    df: DataFrame,
    period: int = 24,
    fit_window: int | None = FIT_WINDOW,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """Regress the seasonal difference on its lags 1, period and period + 1, per series.

    One aggregation builds the 4 x 4 normal equations of every series; only those sums reach the
    solver. ``fit_window`` keeps the newest training points.
    """
    names = as_keys(keys)
    train = df.where(F.col("split") == "train")
    terms = _seasonal_terms(train, period, target, names, ts, step, rows, gaps)
    if fit_window is not None:
        terms = recent_tail(terms, fit_window, names, ts, step)
    used = terms.dropna(subset=["d", "d1", "d2", "d3"]).withColumn("one", F.lit(1.0))
    sums = [F.count(F.lit(1)).alias("n_fit")]
    for i, a in enumerate(_TERMS):
        sums.append(F.sum(F.col(a) * F.col("d")).alias(f"r{i}"))
        sums += [F.sum(F.col(a) * F.col(b)).alias(f"g{i}{j}") for j, b in enumerate(_TERMS) if j >= i]
    systems = used.groupBy(*names).agg(*sums)
    fields = ", ".join(f"`{n}` {systems.schema[n].dataType.simpleString()}" for n in names)
    schema = f"{fields}, " + ", ".join(f"b_{t} double" for t in _TERMS) + ", n_fit bigint"
    return systems.mapInPandas(lambda it: _solve(it, names), schema)


def seasonal_ar_forecast(
    df: DataFrame,
    fitted: DataFrame,
    period: int = 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    model: str = "seasonal_ar",
    split: str = "test",
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """One-step forecasts: the value one season back plus the fitted seasonal difference."""
    names = as_keys(keys)
    scored = attach(
        _seasonal_terms(df, period, target, names, ts, step, rows, gaps).where(F.col("split") == split), fitted, names
    )
    y_pred = (
        F.col("base") + F.col("b_one") + F.col("b_d1") * F.col("d1") + F.col("b_d2") * F.col("d2") + F.col("b_d3") * F.col("d3")
    )
    return scored.select(
        *names, F.lit(model).alias("model"), F.lit("h=1").alias("horizon"), ts,
        F.col(target).alias("y_true"), y_pred.alias("y_pred"),
    )


def forecast_at(
    predictions: DataFrame,
    moment: str,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
) -> DataFrame:
    """Stored forecasts of every model at the timestamp nearest to ``moment`` (ties: the later).

    Only rows at least as near as the nearest one of the series survive the join, so the result is
    one row per series, model and horizon: truth, forecast and signed error.
    """
    names = as_keys(keys)
    distance = F.abs(seconds_between(lit_ts(moment), ts))
    nearest = predictions.groupBy(*names).agg(F.min(F.struct(distance.alias("d"), (-seconds_between(lit_ts(moment), ts)).alias("e"), F.col(ts).alias("t"))).alias("__n"))
    snapped = nearest.select(*names, F.col("__n.t").alias(ts))
    hit = predictions.join(snapped, [*names, ts])
    return hit.select(
        *names, "model", "horizon", ts, F.col("y_true").alias("actual"), F.col("y_pred").alias("forecast"),
        (F.col("y_pred") - F.col("y_true")).alias("error"),
    )


def nearest_times(
    requests: DataFrame,
    table: DataFrame,
    keys: str | Sequence[str] = "series_id",
    requested: str = "requested",
    ts: str = "ts",
    step: int = HOUR,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(keys, requested, ts)``: for each different request the table's nearest timestamp of its series; of
    two equally near ones the later. NULL where the series has no rows or the request no time.

    Requests and rows meet in steps: the rows of one step are a short list, what lies before and after it comes
    from one row per step with either, in buckets, so neither a long series nor many requests are gathered.
    """
    names = as_keys(keys)
    asked = requests.select(*names, naive(requested).alias(requested)).distinct()
    return _snapped(asked, table, names, requested, ts, step, rows).select(*names, requested, ts)


def _snapped(requests: DataFrame, table: DataFrame, names: list[str], requested: str, ts: str, step: int, rows: int) -> DataFrame:
    """All rows and columns of ``requests`` with the nearest timestamp ``ts`` of ``table``."""
    known = table.select(*names, naive(ts).alias("__t")).where("__t IS NOT NULL").withColumn("__step", bucket_of("__t", step, 1))
    asked = requests.select(*names, naive(requested).alias("__t")).select(*names, bucket_of("__t", step, 1).alias("__step")).distinct()
    listed = known.groupBy(*names, "__step").agg(F.sort_array(F.collect_set("__t")).alias("__rows"))
    met = listed.unionByName(asked, allowMissingColumns=True).groupBy(*names, "__step").agg(F.first("__rows", ignorenulls=True).alias("__rows"))
    slots = met.select(
        "*", F.floor(F.col("__step") / rows).alias(BUCKET), F.array_min("__rows").alias("__first"), F.array_max("__rows").alias("__last")
    )
    buckets = slots.groupBy(*names, BUCKET).agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"))

    def beside(group: list[str], order: str) -> list:
        """The nearest row before and after; both run from the first to the current row, in either order."""
        passed = [Window.partitionBy(*group).orderBy(way(order)).rowsBetween(Window.unboundedPreceding, -1) for way in (F.asc, F.desc)]
        return [F.last("__last", ignorenulls=True).over(passed[0]), F.last("__first", ignorenulls=True).over(passed[1])]

    before, after = beside(names, BUCKET)
    carried = buckets.select(*names, BUCKET, before.alias("__before"), after.alias("__after"))
    low, high = beside([*names, BUCKET], "__step")
    placed = slots.select(*names, BUCKET, "__step", "__rows", low.alias("__low"), high.alias("__high"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*names, BUCKET]]
    around = placed.alias("s").join(carried.alias("c"), same).select(
        *[F.col(f"s.{c}").alias(c) for c in names], "__step", "__rows",
        F.coalesce("__low", "__before").alias("__low"), F.coalesce("__high", "__after").alias("__high"),
    )
    timed = requests.withColumn("__t", naive(requested)).withColumn("__step", bucket_of("__t", step, 1))
    found = [F.col(f"q.{c}").eqNullSafe(F.col(f"a.{c}")) for c in [*names, "__step"]]
    joined = timed.alias("q").join(around.alias("a"), found, "left")
    low = F.coalesce(F.array_max(F.filter("__rows", lambda t: t <= F.col("__t"))), F.col("__low"))
    high = F.coalesce(F.array_min(F.filter("__rows", lambda t: t >= F.col("__t"))), F.col("__high"))
    chosen = joined.select(*[F.col(f"q.{c}").alias(c) for c in requests.columns], "__t", low.alias("__below"), high.alias("__above"))
    later = seconds_between("__t", "__above") <= seconds_between("__below", "__t")
    near = F.when(F.col("__below").isNull() | later, F.col("__above")).otherwise(F.col("__below"))
    return chosen.select(*requests.columns, F.when(F.col("__t").isNotNull(), near).alias(ts))


def forecast_requests(
    requests: DataFrame,
    scored: DataFrame,
    keys: str | Sequence[str] = "series_id",
    requested: str = "requested",
    ts: str = "ts",
    step: int = HOUR,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Forecasts of every model and horizon at the row nearest to each requested time.

    ``scored`` are rows of the prediction table, made by stored models from the matrices of their horizons.
    All columns of ``requests`` are kept, with one row per model and horizon that has a forecast there; a
    request whose series has none keeps one row with NULLs.
    """
    names = as_keys(keys)
    placed = _snapped(requests, scored, names, requested, ts, step, rows)
    each = F.struct("model", "horizon", F.col("y_true").alias("actual"), F.col("y_pred").alias("forecast"))
    made = scored.groupBy(*names, ts).agg(F.sort_array(F.collect_list(each)).alias("__made"))
    joined = placed.join(made, [*names, ts], "left").select(*[F.col(c) for c in requests.columns], ts, F.inline_outer("__made"))
    return joined.withColumn("error", F.col("forecast") - F.col("actual"))


def forecast_context(
    series: DataFrame, moment: str, before: int = 48, after: int = 6, ts: str = "ts", step: int = HOUR
) -> DataFrame:
    """The slice around a moment, both ends included."""
    t = lit_ts(moment)
    return series.where(F.col(ts).between(plus_seconds(t, -before * step), plus_seconds(t, after * step)))
