"""The data behind every exploratory view of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattgrid.functions.distributions import normal_quantile
from wattgrid.functions.timeaxis import DAY, HOUR, as_keys, calendar_part, lit_ts, naive, plus_seconds, quoted, seconds_between, slot
from wattgrid.operators.features import rolling_columns
from wattgrid.plans.buckets import attach, expand, over_neighbours
from wattgrid.plans.ranks import cumulative, exact_quantiles

FACTORS = ("hour", "day_of_week", "month")


def slice_between(df: DataFrame, start: str | None = None, end: str | None = None, ts: str = "ts") -> DataFrame:
    """Rows of ``[start, end]``, both ends included; the bounds reach the file scan."""
    out = df
    if start is not None:
        out = out.where(F.col(ts) >= lit_ts(start))
    if end is not None:
        out = out.where(F.col(ts) <= lit_ts(end))
    return out


def zoom(
    df: DataFrame, days: int, offset_days: int = 30, keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """``days`` days of each series, starting ``offset_days`` after its first timestamp."""
    starts = df.groupBy(*as_keys(keys)).agg(F.min(ts).alias("__t0"))
    begin = plus_seconds("__t0", offset_days * DAY)
    joined = attach(df, starts, keys)
    return joined.where(F.col(ts).between(begin, plus_seconds(begin, days * DAY))).drop("__t0")


def _level_rows(df: DataFrame, factors: Sequence[str], target: str, names: list[str], ts: str) -> DataFrame:
    levels = F.inline(F.array(*[
        F.struct(F.lit(f).alias("factor"), calendar_part(f, ts).cast("bigint").alias("level")) for f in factors
    ]))
    # Adding zero makes a negative zero a plain one.
    return df.where(F.col(target).isNotNull()).select(*names, (F.col(target).cast("double") + F.lit(0.0)).alias("v"), levels)


def box_statistics(
    df: DataFrame,
    factors: Sequence[str] = FACTORS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    approximate: bool = False,
) -> DataFrame:
    """Quartiles, whisker ends (1.5 IQR) and outlier count per calendar level.

    Quartiles are exact for groups of any size: rows are counted per value range, and values only in the
    ranges that hold a quartile. ``approximate`` uses the mergeable sketch instead. ``df`` is read several
    times.
    """
    names = as_keys(keys)
    group = [*names, "factor", "level"]
    rows = _level_rows(df, factors, target, names, ts)
    if approximate:
        sketch = rows.groupBy(*group).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx("v", [0.25, 0.5, 0.75]).alias("__q"),
        )
        quartiles = sketch.select(*group, "n", *[F.element_at("__q", i + 1).alias(q) for i, q in enumerate(("q1", "median", "q3"))])
    else:
        found = exact_quantiles(rows, group, "v", (0.25, 0.5, 0.75))
        quartiles = found.select(*group, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("v").between(low, high)
    return attach(rows, quartiles, group).groupBy(*group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
    )


def rolling_statistics(
    df: DataFrame,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    daily: int = 24,
    weekly: int = 168,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """Daily and weekly rolling mean, weekly deviation and its band; the current row is included."""

    def build(d: DataFrame, over: str) -> DataFrame:
        return rolling_columns(d, over, sorted({daily, weekly}), target, shift=0, prefix="__r")

    rolled = over_neighbours(
        df.select(*as_keys(keys), ts, target), build, keys=keys, ts=ts, step=step, before=max(daily, weekly), rows=rows, gaps=gaps
    )
    mean, std = F.col(f"__r_mean_{weekly}"), F.col(f"__r_std_{weekly}")
    return rolled.select(
        *as_keys(keys), ts, target,
        F.col(f"__r_mean_{daily}").alias("mean_daily"), mean.alias("mean_weekly"), std.alias("std_weekly"),
        (mean - std).alias("band_low"), (mean + std).alias("band_high"),
    )


def histogram(
    df: DataFrame, bins: int = 80, target: str = "y", keys: str | Sequence[str] = "series_id"
) -> DataFrame:
    """Counts in ``bins`` equal bins over min..max, last bin closed, empty bins present.

    ``log10_count`` serves the log view and is NULL for empty bins. A constant series is centred in
    a range of width one.
    """
    names = as_keys(keys)
    rows = df.where(F.col(target).isNotNull()).select(*names, F.col(target).cast("double").alias("__v"))
    ends = rows.groupBy(*names).agg(F.min("__v").alias("__a"), F.max("__v").alias("__b"))
    flat = F.col("__a") == F.col("__b")
    ranges = ends.select(
        *names,
        F.when(flat, F.col("__a") - 0.5).otherwise(F.col("__a")).alias("__lo"),
        F.when(flat, F.lit(1.0)).otherwise(F.col("__b") - F.col("__a")).alias("__span"),
    )
    index = F.least(F.floor((F.col("__v") - F.col("__lo")) / F.col("__span") * bins), F.lit(bins - 1)).cast("int")
    counts = attach(rows, ranges, names).groupBy(*names, index.alias("bin")).agg(F.count(F.lit(1)).alias("__n"))
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, [*names, "bin"], "left")
    width = F.col("__span") / bins
    n = F.coalesce("__n", F.lit(0))
    return full.select(
        *names,
        "bin",
        (F.col("__lo") + F.col("bin") * width).alias("bin_low"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("bin_high"),
        n.alias("n"),
        F.when(n > 0, F.log10(n.cast("double"))).alias("log10_count"),
    )


def load_heatmap(df: DataFrame, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts") -> DataFrame:
    """Mean by hour, one column ``dow_0`` .. ``dow_6`` per day of week (Monday first)."""
    day = calendar_part("dayofweek", ts)
    return df.groupBy(*as_keys(keys), F.hour(ts).cast("bigint").alias("hour")).agg(
        *[F.avg(F.when(day == d, F.col(target))).alias(f"dow_{d}") for d in range(7)]
    )


def _month_start(t: str | Column) -> Column:
    return F.trunc(naive(t).cast("date"), "MM").cast("timestamp_ntz")


def monthly_profile(
    df: DataFrame, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """Mean per calendar month, months without data present as NULL."""
    names = as_keys(keys)
    means = df.groupBy(*names, _month_start(ts).alias("month_start")).agg(F.avg(target).alias("mean"))
    ends = means.groupBy(*names).agg(F.min("month_start").alias("__a"), F.max("month_start").alias("__b"))
    months = ends.select(
        *names, F.explode(F.sequence(F.col("__a"), F.col("__b"), F.expr("interval '1' month"))).alias("month_start")
    )
    return months.join(means, [*names, "month_start"], "left")


def decompose(
    df: DataFrame,
    period: int = 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
) -> DataFrame:
    """Classical additive decomposition: centred moving average, phase means, remainder.

    An even period takes both end points of the window at half weight. Phases count from the first
    point of each series and their means are centred.
    """
    names = as_keys(keys)
    half = period // 2
    slim = df.select(*names, ts, F.col(target).cast("double").alias(target))

    def build(d: DataFrame, over: str) -> DataFrame:
        y, span = quoted(target), f"OVER ({over} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
        if period % 2:
            mean = f"avg({y}) {span}"
        else:
            ends = f"(lag({y}, {half}) OVER ({over}) + lead({y}, {half}) OVER ({over})) / 2"
            mean = f"(sum({y}) {span} - {ends}) / {period}"
        return d.selectExpr("*", f"CASE WHEN count({y}) {span} = {2 * half + 1} THEN {mean} END AS trend")

    trended = over_neighbours(slim, build, keys=names, ts=ts, step=step, before=half, after=half, rows=rows)
    starts = slim.groupBy(*names).agg(F.min(slot(ts, step)).alias("__s0"))
    phased = attach(trended, starts, names).withColumn("phase", F.pmod(slot(ts, step) - F.col("__s0"), F.lit(period)).cast("int")).drop("__s0")
    detrended = F.col(target) - F.col("trend")
    phases = phased.groupBy(*names, "phase").agg(F.avg(detrended).alias("__p"))
    level = phases.groupBy(*names).agg(F.avg("__p").alias("__c"))
    seasonal = phases.join(level, names).select(*names, "phase", (F.col("__p") - F.col("__c")).alias("seasonal"))
    joined = attach(phased, seasonal, [*names, "phase"])
    return joined.select(
        *names, ts, target, "phase", "trend", "seasonal",
        (F.col(target) - F.col("trend") - F.col("seasonal")).alias("remainder"),
    )


def qq_points(
    df: DataFrame, value: str = "residual", keys: str | Sequence[str] = ("series_id", "model"), points: int | None = None
) -> DataFrame:
    """Ordered values against normal quantiles at Filliben's plotting positions.

    Equal values are counted, ranked by value ranges and spread out again in chunks. With ``points`` only
    that many order statistics are selected, equally spaced in rank and with both ends: a counted value
    knows which of the wanted ranks fall into its own ranks, so no other row is made. A group of fewer
    values gives all of them.
    """
    if points is not None and points < 2:
        raise ValueError("at least the two ends are selected")
    names = as_keys(keys)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*names, F.col(value).cast("double").alias("ordered"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = cumulative(counts, names, "ordered").select(*names, "ordered", "ties", "upto", "total")
    if points is None:
        made = expand(ranked, F.col("upto") - F.col("ties") + 1, F.col("upto"), "i")
    else:
        # The k-th wanted rank is 1 + (k - 1) * (total - 1) div (points - 1).
        steps = points - 1
        first = F.expr(f"if(total <= {points}, upto - ties + 1, 1 + ((upto - ties) * {steps} + total - 2) div (total - 1))")
        last = F.expr(f"if(total <= {points}, upto, least({points}, (upto * {steps} + total - 2) div (total - 1)))")
        rank = F.expr(f"if(total <= {points}, k, 1 + ((k - 1) * (total - 1)) div {steps})")
        made = expand(ranked, first, last, "k").withColumn("i", rank)
    n, i = F.col("total").cast("double"), F.col("i").cast("double")
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    position = F.when(i == n, top).when(i == 1, F.lit(1.0) - top).otherwise((i - 0.3175) / (n + 0.365))
    return made.select(*names, "i", "ordered", normal_quantile(position).alias("theoretical"))


def qq_line(points: DataFrame, keys: str | Sequence[str] = ("series_id", "model")) -> DataFrame:
    """Least-squares line through the Q-Q points and its correlation."""
    return points.groupBy(*as_keys(keys)).agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"),
    )


def actual_vs_predicted(
    predictions: DataFrame,
    models: Sequence[str],
    start: str,
    days: int = 7,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
) -> DataFrame:
    """Truth of the first model and one forecast column per model over ``[start, start + days]``."""
    begin = lit_ts(start)
    rows = predictions.where(F.col(ts).between(begin, plus_seconds(begin, days * DAY)) & F.col("model").isin(list(models)))

    def of(m: str, c: str) -> Column:
        return F.max(F.when(F.col("model") == m, F.col(c)))

    return rows.groupBy(*as_keys(keys), ts).agg(of(models[0], "y_true").alias("y_true"), *[of(m, "y_pred").alias(m) for m in models])


def week_grid(df: DataFrame, keys: str | Sequence[str] = "series_id", ts: str = "ts") -> DataFrame:
    """Week starts every seven days from midnight of the first timestamp to the last."""
    names = as_keys(keys)
    ends = df.groupBy(*names).agg(F.min(naive(ts)).alias("__a"), F.max(naive(ts)).alias("__b"))
    first = F.col("__a").cast("date").cast("timestamp_ntz")
    return ends.select(*names, F.explode(F.sequence(first, F.col("__b"), F.expr("interval '7' day"))).alias("week_start"))


def nearest_week(
    df: DataFrame, moment: str, keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """The grid week nearest a date; of two equally near ones the first."""
    weeks = week_grid(df, keys, ts)
    distance = F.abs(seconds_between(lit_ts(moment), "week_start"))
    return weeks.groupBy(*as_keys(keys)).agg(F.min_by("week_start", F.struct(distance, F.col("week_start"))).alias("week_start"))


def dataset_summary(df: DataFrame, keys: str | Sequence[str] = "series_id", ts: str = "ts") -> DataFrame:
    """Row count, first and last date per series."""
    t = naive(ts)
    return df.groupBy(*as_keys(keys)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(t).cast("date").alias("first_date"), F.max(t).cast("date").alias("last_date")
    )


def describe(df: DataFrame, columns: Sequence[str], keys: str | Sequence[str] = "series_id") -> DataFrame:
    """Count, mean, deviation, min, quartiles and max per column: one row per series and column.

    Quartiles are exact, see :func:`box_statistics`.
    """
    names = as_keys(keys)
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = df.select(*names, pairs).where(F.col("v").isNotNull())
    group = [*names, "column"]
    moments = long.groupBy(*group).agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    quartiles = exact_quantiles(long, group, "v", (0.25, 0.5, 0.75))
    return moments.join(quartiles.drop("n"), group).select(
        *group, "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max"
    )
