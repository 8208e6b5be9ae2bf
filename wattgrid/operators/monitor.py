"""Drift, error and retraining checks for a running forecaster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wattgrid.functions.timeaxis import DAY, HOUR, as_keys, lit_ts, naive, plus_seconds, quoted, seconds_between
from wattgrid.operators.features import rolling_columns
from wattgrid.operators.metrics import mase
from wattgrid.plans.buckets import attach, over_neighbours
from wattgrid.plans.ranks import cumulative

PSI_BINS = 10
PSI_ALERT = 0.2
FLOOR = 1e-4


def _tagged(df: DataFrame, value: str, boundary: str, names: list[str], ts: str) -> DataFrame:
    period = F.when(F.col(ts) < lit_ts(boundary), "reference").otherwise("current")
    return df.where(F.col(value).isNotNull()).select(*names, F.col(value).cast("double").alias("v"), period.alias("period"))


def population_stability(
    df: DataFrame,
    value: str,
    boundary: str,
    bins: int = PSI_BINS,
    threshold: float = PSI_ALERT,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
) -> DataFrame:
    """Population-stability index of a feature after ``boundary`` against the time before it.

    Equal bins over the reference range, outer bins open; shares are floored so that an empty bin
    stays finite.
    """
    names = as_keys(keys)
    rows = _tagged(df, value, boundary, names, ts)
    reference = rows.where(F.col("period") == "reference")
    ends = reference.groupBy(*names).agg(F.min("v").alias("__lo"), (F.max("v") - F.min("v")).alias("__span"))
    raw = F.floor((F.col("v") - F.col("__lo")) / F.nullif(F.col("__span"), F.lit(0.0)) * bins)
    index = F.coalesce(F.greatest(F.lit(0), F.least(raw, F.lit(bins - 1))), F.lit(0)).cast("int")
    counted = attach(rows, ends, names).groupBy(*names, index.alias("bin")).agg(
        F.count_if(F.col("period") == "reference").alias("__r"), F.count_if(F.col("period") == "current").alias("__c")
    )
    grid = ends.select(*names, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counted, [*names, "bin"], "left").fillna(0, ["__r", "__c"])
    series = Window.partitionBy(*names)
    r = F.greatest(F.col("__r") / F.sum("__r").over(series), F.lit(FLOOR))
    c = F.greatest(F.try_divide("__c", F.sum("__c").over(series)), F.lit(FLOOR))
    shares = full.withColumn("__rs", r).withColumn("__cs", c)
    psi = F.sum((F.col("__cs") - F.col("__rs")) * F.log(F.col("__cs") / F.col("__rs")))
    return shares.groupBy(*names).agg(psi.alias("psi")).withColumn("drift", F.col("psi") > threshold)


def kolmogorov_smirnov(
    df: DataFrame, value: str, boundary: str, keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """Largest gap of the two cumulative distributions before and after ``boundary``."""
    names = as_keys(keys)
    rows = _tagged(df, value, boundary, names, ts)
    counts = rows.groupBy(*names, "period", "v").agg(F.count(F.lit(1)).alias("n"))
    totals = rows.groupBy(*names).agg(
        F.count_if(F.col("period") == "reference").alias("n_reference"), F.count_if(F.col("period") == "current").alias("n_current")
    )
    # Shares of both periods per value, walked together: the running difference is the gap.
    shares = attach(counts, totals, names)
    signed = shares.groupBy(*names, "v").agg(
        F.sum(
            F.when(F.col("period") == "reference", F.col("n") / F.col("n_reference")).otherwise(-F.col("n") / F.col("n_current"))
        ).alias("__d")
    )
    gap = cumulative(signed, names, "v", "__d").groupBy(*names).agg(F.max(F.abs("upto")).alias("ks"))
    return gap.join(totals, names).select(*names, "n_reference", "n_current", "ks")


def retrain_decision(
    drift: DataFrame,
    errors: DataFrame,
    as_of: str,
    trained_at: str,
    max_age_days: int = 30,
    mase_limit: float = 1.0,
    keys: str | Sequence[str] = "series_id",
) -> DataFrame:
    """Retrain on drift, on a MASE at or over the limit, or when the fit is too old.

    ``drift`` is ``(keys, drift)``, ``errors`` is ``(keys, mase)``.
    """
    names = as_keys(keys)
    joined = drift.select(*names, "drift").join(errors.select(*names, "mase"), names, "full")
    old = seconds_between(lit_ts(trained_at), lit_ts(as_of)) >= max_age_days * 86400
    d = F.coalesce("drift", F.lit(False))
    m = F.coalesce(F.col("mase") >= mase_limit, F.lit(False))
    reason = F.when(d, "drift").when(m, "mase").when(old, "age").otherwise("none")
    return joined.select(*names, d.alias("drift"), m.alias("mase_breach"), old.alias("too_old"), (d | m | old).alias("retrain"), reason.alias("reason"))


def retrain_alerts(
    predictions: DataFrame,
    scale: DataFrame | float,
    window: int = 24,
    limit: float = 1.0,
    hold: int = 24,
    max_age_days: int = 30,
    until: str | None = None,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    gaps: str = "rows",
) -> DataFrame:
    """Moments at which a model should be trained again: ``(keys, model, kind, ts, since)``.

    * ``error``: the MASE over the last ``window`` predictions was at or over ``limit`` for ``hold`` predictions
      in a row. One alert per such run, at its ``hold``-th prediction; ``since`` is its first one. A window that
      is not full or holds a NULL breaches nothing and ends a run.
    * ``age``: no newer fit was in use when the newest one, of ``fitted_at``, became ``max_age_days`` old;
      ``since`` is that fit. A fit is in use from its first prediction; one that is older than a fit seen
      before it, or NULL, is ignored. Looked for up to ``until`` (default: the last prediction of the model).

    ``predictions`` holds each timestamp once per series and model; rows without key, model or timestamp are left out.
    """
    names = [*as_keys(keys), "model"]
    kept = predictions.dropna(subset=[*names, ts])
    errors = kept.select(*names, ts, F.abs(F.col("y_true") - F.col("y_pred")).cast("double").alias("__err"))
    if isinstance(scale, DataFrame):
        errors = attach(errors, scale.select(*as_keys(keys), F.col("scale").cast("double")), keys, how="left")
    else:
        errors = errors.withColumn("scale", F.lit(scale).cast("double"))

    def runs(d: DataFrame, over: str) -> DataFrame:
        rolled = rolling_columns(d, over, [window], "__err", shift=0, prefix="__r")
        hot = F.coalesce(mase(F.col(f"__r_mean_{window}"), F.col("scale")) >= limit, F.lit(False))
        counted = [f"count_if(__hot) OVER ({over} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS __n{n}" for n in (hold - 1, hold)]
        return rolled.withColumn("__hot", hot).selectExpr("*", *counted, f"lag({quoted(ts)}, {hold - 1}) OVER ({over}) AS since")

    found = over_neighbours(errors, runs, keys=names, ts=ts, step=step, before=window + hold, gaps=gaps)
    breaches = found.where(f"__n{hold - 1} = {hold} AND __n{hold} = {hold}").select(
        *names, F.lit("error").alias("kind"), naive(ts).alias(ts), naive("since").alias("since")
    )

    # One row per fit from here on.
    fits = kept.where(F.col("fitted_at").isNotNull()).groupBy(*names, naive("fitted_at").alias("since")).agg(
        F.min(naive(ts)).alias("__first")
    )
    order = Window.partitionBy(*names).orderBy("__first", F.desc("since"))
    newest = F.max("since").over(order.rowsBetween(Window.unboundedPreceding, -1))
    used = fits.withColumn("__newest", newest).where(F.col("__newest").isNull() | (F.col("since") > F.col("__newest")))
    due = used.select(
        *names, F.lit("age").alias("kind"), plus_seconds("since", max_age_days * DAY).alias(ts), "since",
        F.lead("__first").over(Window.partitionBy(*names).orderBy("__first")).alias("__next"),
    ).where(F.col("__next").isNull() | (F.col(ts) < F.col("__next"))).drop("__next")
    if until is not None:
        overdue = due.where(F.col(ts) <= lit_ts(until))
    else:
        last = kept.groupBy(*names).agg(F.max(naive(ts)).alias("__last"))
        overdue = due.join(last, names).where(F.col(ts) <= F.col("__last")).drop("__last")
    return breaches.unionByName(overdue)
