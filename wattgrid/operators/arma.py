"""Seasonal autoregression with moving-average terms, fitted in two regressions.

The model of the seasonal difference ``w`` is ``w = c + f . (w at lags 1, p, p + 1) + g . (e at lags 1, p, p + 1) + e``.
Its innovations ``e`` cannot be seen, so a longer autoregression estimates them first (Hannan and Rissanen, 1982)
and the model is then regressed on them. Residuals of the fitted model follow ``e = u - g . (e at the lags)``
with a known ``u``: each row maps the last ``p + 1`` residuals by the same matrix plus its ``u``. Blocks
of rows are therefore run from zero first, their end states joined along the series, one row per block, and run again from
the state that really precedes them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys, naive, quoted
from wattgrid.operators.features import recent_tail
from wattgrid.operators.forecast import FIT_WINDOW
from wattgrid.plans.buckets import BUCKET, BUCKET_ROWS, attach, bucket_of, over_neighbours
from wattgrid.session import staged

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
MODEL_TERMS = ["one", "w1", "wp", "wp1", "e1", "ep", "ep1"]


def _number(target: str) -> Column:
    """The target as a double; not-a-number is as unknown as NULL."""
    value = F.col(target).cast("double")
    return F.when(~F.isnan(value), value)


def long_lags(period: int) -> list[int]:
    """Lags of the first regression: around one step, one period and two periods."""
    return [1, 2, 3, period, period + 1, period + 2, 2 * period, 2 * period + 1]


def regress(df: DataFrame, target: str, terms: Sequence[str], keys: str | Sequence[str]) -> DataFrame:
    """Least squares per series: ``(keys, b_<term>..., n_fit)``. One aggregation sums the normal equations,
    only these reach the solver; a singular system takes the least-norm solution."""
    names, k = as_keys(keys), len(terms)
    used = df.dropna(subset=[target, *terms])
    products = [F.sum(F.col(terms[i]) * F.col(terms[j])).alias(f"__g{i}_{j}") for i in range(k) for j in range(i, k)]
    right = [F.sum(F.col(terms[i]) * F.col(target)).alias(f"__r{i}") for i in range(k)]
    sums = used.groupBy(*names).agg(F.count(F.lit(1)).alias("n_fit"), *products, *right)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gram = np.empty((len(batch), k, k))
            for i in range(k):
                for j in range(i, k):
                    gram[:, i, j] = gram[:, j, i] = batch[f"__g{i}_{j}"]
            aim = np.stack([batch[f"__r{i}"].to_numpy(float) for i in range(k)], axis=1)
            solved = np.einsum("nij,nj->ni", np.linalg.pinv(gram, hermitian=True), aim)
            yield batch[names].assign(**{f"b_{t}": solved[:, i] for i, t in enumerate(terms)}, n_fit=batch["n_fit"].to_numpy())

    fields = ", ".join(f"{quoted(n)} {sums.schema[n].dataType.simpleString()}" for n in names)
    return sums.mapInPandas(solve, f"{fields}, " + ", ".join(f"b_{t} double" for t in terms) + ", n_fit bigint")


def _differences(over: str, target: str, period: int, lags: Sequence[int]) -> list[str]:
    def y(k: int) -> str:
        return f"lag({quoted(target)}, {k}) OVER ({over})" if k else quoted(target)

    return [f"{y(k)} - {y(k + period)} AS __w{k}" for k in [0, *lags]]


def fit_long_autoregression(
    df: DataFrame, period: int = 24, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts",
    step: int = HOUR, rows: int | None = None, gaps: str = "fail",
) -> DataFrame:
    """The first regression: the seasonal difference on a constant and ``long_lags``, per series."""
    names, lags = as_keys(keys), long_lags(period)
    slim = df.select(*names, ts, _number(target).alias(target))
    made = over_neighbours(
        slim, lambda d, over: d.selectExpr("*", *_differences(over, target, period, lags)),
        keys=names, ts=ts, step=step, before=max(lags) + period, rows=rows, gaps=gaps,
    )
    return regress(made.withColumn("one", F.lit(1.0)), "__w0", ["one", *[f"__w{k}" for k in lags]], names)


def fit_seasonal_arma(
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
    """Both regressions over the newest ``fit_window`` training points: ``(keys, b_one, b_w1, b_wp, b_wp1, b_e1,
    b_ep, b_ep1, n_fit, radius)``.

    ``radius`` is the spectral radius of the recursion of the residuals. From 1 on they do not forget where they
    started, and :func:`arma_residuals` gives NULL. A row whose lags reach before the window or a NULL is left
    out of the regression; a series without any whole row has no fit.
    """
    if period < 3:
        raise ValueError("a period has at least 3 steps")
    names, lags = as_keys(keys), long_lags(period)
    train = df.where(F.col("split") == "train").select(*names, ts, _number(target).alias(target))
    if fit_window is not None:
        train = recent_tail(train, fit_window, names, ts, step)
    train = staged(train)
    first = fit_long_autoregression(train, period, target, names, ts, step, rows, gaps)
    known = attach(train, first.drop("n_fit"), names)

    def build(d: DataFrame, over: str) -> DataFrame:
        inner = d.selectExpr("*", *_differences(over, target, period, lags))
        fitted = " + ".join(["b_one", *[f"`b___w{k}` * __w{k}" for k in lags]])
        seen = inner.selectExpr("*", f"__w0 - ({fitted}) AS __e")
        past = [f"lag(__e, {k}) OVER ({over}) AS {n}" for k, n in ((1, "e1"), (period, "ep"), (period + 1, "ep1"))]
        return seen.selectExpr("*", "1.0D AS one", "__w1 AS w1", f"__w{period} AS wp", f"__w{period + 1} AS wp1", *past)

    reach = max(lags) + period + period + 1
    terms = over_neighbours(known, build, keys=names, ts=ts, step=step, before=reach, rows=rows, gaps=gaps)
    fitted = regress(terms, "__w0", MODEL_TERMS, names)

    def with_radius(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            thetas = batch[["b_e1", "b_ep", "b_ep1"]].to_numpy(float)
            yield batch.assign(radius=[float(np.abs(np.linalg.eigvals(_matrix(t, period))).max()) for t in thetas])

    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fitted.schema)
    return fitted.mapInPandas(with_radius, f"{fields}, radius double")


def _matrix(theta: Sequence[float], period: int) -> np.ndarray:
    """What one row does to the last ``period + 1`` residuals, the newest first, without its own ``u``."""
    m = np.eye(period + 1, k=-1)
    m[0, 0], m[0, period - 1], m[0, period] = -theta[0], m[0, period - 1] - theta[1], -theta[2]
    return m


def run_residuals(u: np.ndarray, theta: Sequence[float], state: np.ndarray, period: int) -> np.ndarray:
    """Residuals of consecutive rows after ``state`` (the last ``period + 1``, the newest first); a row with an
    unknown ``u`` has residual 0. ``period`` rows at once: their seasonal terms are known, and what they owe
    to the row before them is one triangular product."""
    short, seasonal, both = theta
    n, lead = len(u), period + 1
    e = np.concatenate([state[::-1], np.zeros(n)])
    if np.isnan(u).any():
        for t in range(n):
            v = u[t] - short * e[lead + t - 1] - seasonal * e[lead + t - period] - both * e[lead + t - period - 1]
            e[lead + t] = 0.0 if np.isnan(v) else v
        return e[lead:]
    powers = (-short) ** np.arange(period + 1)
    distance = np.arange(period)[:, None] - np.arange(period)[None, :]
    triangle = np.where(distance >= 0, powers[np.maximum(distance, 0)], 0.0)
    for t in range(0, n, period):
        m = min(period, n - t)
        at = lead + t
        v = u[t:t + m] - seasonal * e[at - period:at - period + m] - both * e[at - period - 1:at - period - 1 + m]
        e[at:at + m] = triangle[:m, :m] @ v + powers[1:m + 1] * e[at - 1]
    return e[lead:]


def _end_state(e: np.ndarray, state: np.ndarray) -> np.ndarray:
    return np.concatenate([state[::-1], e])[-len(state):][::-1]


def arma_residuals(
    df: DataFrame,
    fitted: DataFrame,
    period: int = 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
    gaps: str = "fail",
    block: int = BUCKET_ROWS,
) -> DataFrame:
    """One-step residuals of every row: ``(keys, ts, target, residual)``.

    Residuals before the first row with a whole history are 0, and so is for the recursion that of a row whose
    target or lags are NULL; its own ``residual`` is NULL. So are those of a series without a fit or with a
    ``radius`` of 1 or more. Rows repeat their arithmetic in blocks of ``block`` time steps; the result does not
    depend on the block but for rounding.
    """
    names, size = as_keys(keys), period + 1
    slim = df.select(*names, ts, _number(target).alias(target))
    lags = [1, period, period + 1]
    terms = over_neighbours(
        slim, lambda d, over: d.selectExpr("*", *_differences(over, target, period, lags)),
        keys=names, ts=ts, step=step, before=2 * period + 1, rows=rows, gaps=gaps,
    )
    scored = attach(terms, fitted.where("radius < 1"), names, how="left")
    u = F.expr(f"__w0 - b_one - b_w1 * __w1 - b_wp * __w{period} - b_wp1 * __w{period + 1}")
    theta = F.expr("array(b_e1, b_ep, b_ep1)")
    cells = scored.select(
        *names, bucket_of(ts, step, block).alias(BUCKET), theta.alias("theta"),
        F.struct(naive(ts).alias("t"), u.alias("u"), F.col(target).alias("y")).alias("__row"),
    )
    collected = [F.first("theta").alias("theta"), F.sort_array(F.collect_list("__row")).alias("__rows")]
    blocks = staged(cells.groupBy(*names, BUCKET).agg(*collected))
    runs = blocks.select(*names, BUCKET, "theta", F.expr("transform(__rows, r -> r.u)").alias("u")).where("theta[0] IS NOT NULL")
    kinds = ", ".join(f"{quoted(n)} {blocks.schema[n].dataType.simpleString()}" for n in [*names, BUCKET])

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            zero = np.zeros(size)
            values = [np.asarray(u, float) for u in batch["u"]]
            made = [_end_state(run_residuals(u, theta, zero, period), zero) for theta, u in zip(batch["theta"], values)]
            holes = [np.flatnonzero(np.isnan(u)) for u in values]
            yield batch[[*names, BUCKET]].assign(theta=batch["theta"], n=[len(u) for u in values], shift=made, holes=holes)

    summary = runs.mapInPandas(ends, f"{kinds}, theta array<double>, n bigint, shift array<double>, holes array<bigint>")

    def join_up(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(BUCKET)
        m, powers, state, states = _matrix(table["theta"].iloc[0], period), {}, np.zeros(size), []

        def after(n: int, state: np.ndarray) -> np.ndarray:
            if n not in powers:
                powers[n] = np.linalg.matrix_power(m, n)
            return powers[n] @ state

        for n, shift, holes in zip(table["n"], table["shift"], table["holes"]):
            states.append(state)
            at = 0
            for hole in holes:  # a row without u has residual 0 whatever came before it
                state = np.concatenate([[0.0], after(int(hole) - at, state)[:-1]])
                at = int(hole) + 1
            state = after(int(n) - at, state) + np.asarray(shift)
        return table[[*names, BUCKET]].assign(state=states)

    # One row of p + 1 numbers per block of a series.
    states = summary.groupBy(*names).applyInPandas(join_up, f"{kinds}, state array<double>")
    started = blocks.join(states, [*names, BUCKET], "left")

    def residuals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for theta, state, u in zip(batch["theta"], batch["state"], batch["u"]):
                u = np.asarray(u, float)
                if state is None:
                    made.append([None] * len(u))
                    continue
                e = run_residuals(u, theta, np.asarray(state), period)
                made.append([None if missing else x for x, missing in zip(e.tolist(), np.isnan(u))])
            yield batch[[*names, BUCKET]].assign(t=batch["t"], y=batch["y"], e=made)

    micros = f"cast(cast(cast(r.t - {_EPOCH} AS interval second) AS decimal(20,6)) * 1000000 AS bigint)"
    flat = started.select(
        *names, BUCKET, "theta", "state", F.expr("transform(__rows, r -> r.u)").alias("u"),
        F.expr(f"transform(__rows, r -> {micros})").alias("t"), F.expr("transform(__rows, r -> r.y)").alias("y"),
    )
    lists = flat.mapInPandas(residuals, f"{kinds}, t array<bigint>, y array<double>, e array<double>")
    unfolded = lists.select(*names, F.expr("inline(arrays_zip(t, y, e))"))
    moment = F.expr(f"{_EPOCH} + make_dt_interval(0, 0, 0, cast(t AS decimal(20,0)) / 1000000)")
    return unfolded.select(*names, moment.cast(slim.schema[ts].dataType).alias(ts), F.col("y").alias(target), F.col("e").alias("residual"))


def seasonal_arma_forecast(
    df: DataFrame,
    fitted: DataFrame,
    period: int = 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    model: str = "seasonal_arma",
    split: str = "test",
    rows: int | None = None,
    gaps: str = "fail",
    block: int = BUCKET_ROWS,
) -> DataFrame:
    """One-step forecasts of the rows of ``split``: what the residual leaves of the value."""
    names = as_keys(keys)
    found = arma_residuals(df, fitted, period, target, names, ts, step, rows, gaps, block)
    wanted = df.where(F.col("split") == split).select(*names, ts)
    return found.join(wanted, [*names, ts], "left_semi").select(
        *names, F.lit(model).alias("model"), F.lit("h=1").alias("horizon"), ts,
        F.col(target).alias("y_true"), (F.col(target) - F.col("residual")).alias("y_pred"),
    )
