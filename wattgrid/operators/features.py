"""Leakage-safe features: nothing here reads a value later than the row's own origin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattgrid.functions.holidays import flag_dates, flag_french_holidays
from wattgrid.functions.timeaxis import HOUR, as_keys, lit_ts, plus_seconds, quoted
from wattgrid.plans.blocks import block_windows
from wattgrid.plans.buckets import attach, over_neighbours

LAGS = [1, 24, 48, 168, 336]
ROLLING_WINDOWS = [24, 168]
TEST_START = "2010-01-01"
LOOKBACK = 168
CONTEXT = 1024
BLOCK = 12

# Columns never offered to a model. The meter channels are unknown at forecast
# time, the year cannot be extrapolated, the rest are labels.
LEAKING_CHANNELS = [
    "Global_reactive_power",
    "Voltage",
    "Global_intensity",
    "Sub_metering_1",
    "Sub_metering_2",
    "Sub_metering_3",
]
# The calendar columns of a model matrix, in order.
CALENDAR_FEATURES = [
    "hour",
    "dayofweek",
    "day",
    "month",
    "quarter",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "dayofweek_sin",
    "dayofweek_cos",
    "month_sin",
    "month_cos",
    "is_holiday",
]
CYCLES = {"hour": ("hour", 24), "dayofweek": ("weekday", 7), "month": ("month", 12)}


def add_calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour, day of week (Monday = 0), day, month, quarter, year and the weekend flag."""
    t = quoted(ts)
    return df.selectExpr(
        "*",
        f"cast(hour({t}) AS smallint) AS hour",
        f"cast(weekday({t}) AS smallint) AS dayofweek",
        f"cast(day({t}) AS smallint) AS day",
        f"cast(month({t}) AS smallint) AS month",
        f"cast(quarter({t}) AS smallint) AS quarter",
        f"cast(year({t}) AS smallint) AS year",
        f"cast(weekday({t}) >= 5 AS tinyint) AS is_weekend",
    )


def add_cyclical_encodings(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Sine and cosine of hour, day of week and month."""
    t, waves = quoted(ts), []
    for name, (part, period) in CYCLES.items():
        angle = f"2 * pi() * {part}({t}) / {period}"
        waves += [f"sin({angle}) AS {name}_sin", f"cos({angle}) AS {name}_cos"]
    return df.selectExpr("*", *waves)


def add_holiday_flag(df: DataFrame, ts: str = "ts", calendar: DataFrame | None = None) -> DataFrame:
    """French public holidays by rule, or the dates of a ``calendar(date)`` table."""
    if calendar is not None:
        return flag_dates(df, calendar, ts)
    return flag_french_holidays(df, ts)


def _lags(over: str, lags: Sequence[int], target: str) -> list[str]:
    return [f"lag({quoted(target)}, {k}) OVER ({over}) AS lag_{k}" for k in lags]


def block_length(size: int) -> int:
    """Largest divisor of the window length that a sliding frame can re-add cheaply."""
    return max(d for d in range(1, min(size, BLOCK) + 1) if size % d == 0)


def rolling_columns(
    df: DataFrame, over: str, sizes: Sequence[int], target: str, shift: int = 1, prefix: str = "roll"
) -> DataFrame:
    """Rolling mean and sample deviation over the ``size`` rows that end ``shift`` rows back.

    A sliding frame re-adds all its rows for each output row, which is costly for a week of
    hours. So short blocks are aggregated by a sliding frame and a window is put together from
    lagged blocks. Only non-negative terms are added, so nothing cancels. NULL until the window
    is full and whenever a member is NULL.
    """
    value = f"cast({quoted(target)} AS double)"
    short = []
    for b in sorted({block_length(s) for s in sizes}):
        frame = f"OVER ({over} ROWS BETWEEN {_back(shift + b - 1)} AND {_back(shift)})"
        short += [
            f"CASE WHEN count({value}) {frame} = {b} THEN avg({value}) {frame} END AS __mean{b}",
            f"CASE WHEN count({value}) {frame} = {b} THEN var_pop({value}) {frame} END AS __var{b}",
        ]
    blocks = df.selectExpr("*", *short)

    parts, means, deviations = [], [], []
    for s in sizes:
        b = block_length(s)
        for kind in ("mean", "var"):
            lagged = ", ".join(f"lag(__{kind}{b}, {b * j}) OVER ({over})" if j else f"__{kind}{b}" for j in range(s // b))
            parts.append(f"array({lagged}) AS __{kind}s{s}")
        total = " + ".join(f"__means{s}[{j}]" for j in range(s // b))
        means.append(f"({total}) / {s // b} AS {prefix}_mean_{s}")
        within = " + ".join(f"__vars{s}[{j}]" for j in range(s // b))
        between = " + ".join(f"power(__means{s}[{j}] - {prefix}_mean_{s}, 2)" for j in range(s // b))
        deviations.append(f"sqrt({b} * ({within} + {between}) / {s - 1})" if s > 1 else "cast(NULL AS double)")
    kept = [quoted(c) for c in df.columns]
    assembled = blocks.selectExpr(*kept, *parts).selectExpr("*", *means)
    named = [m for s, d in zip(sizes, deviations) for m in (f"{prefix}_mean_{s}", f"{d} AS {prefix}_std_{s}")]
    return assembled.selectExpr(*kept, *named)


def _back(rows: int) -> str:
    return f"{rows} PRECEDING" if rows else "CURRENT ROW"


def add_lag_features(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """Past values ``lag_k`` of the target, counted in rows (``gaps`` as in ``over_neighbours``)."""
    return over_neighbours(
        df,
        lambda d, over: d.selectExpr("*", *_lags(over, lags, target)),
        keys=keys, ts=ts, step=step, before=max(lags), rows=rows, gaps=gaps,
    )


def add_rolling_features(
    df: DataFrame,
    windows: Sequence[int] = ROLLING_WINDOWS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """Causal rolling mean and sample deviation; the current row is never in its own window."""
    return over_neighbours(
        df,
        lambda d, over: rolling_columns(d, over, windows, target),
        keys=keys, ts=ts, step=step, before=max(windows), rows=rows, gaps=gaps,
    )


def build_features(
    df: DataFrame,
    target: str = "y",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING_WINDOWS,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    calendar: DataFrame | None = None,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """All feature families; lags and rolling windows share one shuffle and one sort (``gaps`` as in
    ``over_neighbours``).

    The date columns are computed between two window steps. That keeps the generated code of each
    step small enough to be compiled, and the columns out of the shuffle.
    """

    def build(d: DataFrame, over: str) -> DataFrame:
        lagged = add_cyclical_encodings(add_calendar_features(d.selectExpr("*", *_lags(over, lags, target)), ts), ts)
        flagged = lagged if calendar is not None else add_holiday_flag(lagged, ts)
        return rolling_columns(flagged, over, windows, target)

    made = over_neighbours(
        df, build, keys=keys, ts=ts, step=step, before=max([*lags, *windows]), rows=rows, gaps=gaps
    )
    if calendar is not None:
        made = add_holiday_flag(made, ts, calendar)
    history = history_columns(made)
    first = [c for c in made.columns if c not in history and c != "is_holiday"]
    return made.select(*first, *history, "is_holiday")


def chronological_split(df: DataFrame, test_start: str = TEST_START, ts: str = "ts") -> DataFrame:
    """Label rows before the boundary ``train``, the others ``test``."""
    return df.withColumn("split", F.when(F.col(ts) < lit_ts(test_start), "train").otherwise("test"))


def history_columns(df: DataFrame) -> list[str]:
    """Lag and rolling columns, found by name."""
    return [c for c in df.columns if c.startswith(("lag_", "roll_"))]


def drop_warmup(df: DataFrame) -> DataFrame:
    """Drop rows with an undefined lag or rolling feature."""
    return df.dropna(subset=history_columns(df))


def count_warmup(df: DataFrame, keys: str | Sequence[str] = "series_id") -> DataFrame:
    """Rows that :func:`drop_warmup` removes and keeps, per series."""
    undefined = F.lit(False)
    for c in history_columns(df):
        undefined = undefined | F.col(c).isNull()
    return df.groupBy(*as_keys(keys)).agg(
        F.count_if(undefined).alias("n_dropped"), F.count_if(~undefined).alias("n_kept")
    )


def feature_names(
    df: DataFrame, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> list[str]:
    """Columns a model may use: everything but keys, time, labels, target and leaking channels."""
    denied = {*LEAKING_CHANNELS, "year", "split", target, ts, *as_keys(keys)}
    return [c for c in df.columns if c not in denied]


def model_matrix(
    df: DataFrame, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """Key, time, split, target and the model features; filter on ``split`` for either part."""
    return df.select(*as_keys(keys), ts, "split", target, *feature_names(df, target, keys, ts))


def direct_matrix(
    df: DataFrame,
    horizon: int = 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    include_origin: bool = False,
    rows: int | None = None,
    gaps: str = "rows",
) -> DataFrame:
    """Matrix for forecasting ``horizon`` steps ahead, one row per predicted timestamp.

    Calendar columns are those of the predicted time; lag and rolling columns are the ones known
    ``horizon`` rows earlier. With ``include_origin`` the value at the origin itself is added. The
    input has usually lost rows (``drop_warmup``), so rows are counted by position.
    """
    history = history_columns(df)

    def shifted(d: DataFrame, over: str) -> DataFrame:
        rest = [quoted(c) for c in d.columns if c not in history]
        moved = [f"lag({quoted(c)}, {horizon}) OVER ({over}) AS {quoted(c)}" for c in history]
        if include_origin:
            moved.append(f"lag({quoted(target)}, {horizon}) OVER ({over}) AS origin_value")
        return d.selectExpr(*rest, *moved)

    names = as_keys(keys)
    moved = over_neighbours(df, shifted, keys=names, ts=ts, step=step, before=horizon, rows=rows, gaps=gaps)
    features = [*CALENDAR_FEATURES, *history, *(["origin_value"] if include_origin else [])]
    return moved.dropna(subset=[*features, target]).select(*names, ts, "split", target, *features)


def lookback_windows(
    df: DataFrame,
    length: int = LOOKBACK,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    start: str | None = None,
    stop: str | None = None,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """``(window, y)`` pairs: the ``length`` values before each row of ``[start, stop)``."""
    names = as_keys(keys)
    slim = df.select(*names, ts, target)
    if stop is not None:
        slim = slim.where(F.col(ts) < lit_ts(stop))
    if start is not None:
        slim = slim.where(F.col(ts) >= plus_seconds(lit_ts(start), -length * step))
    made = block_windows(slim, target, length, 1, "window", keys=names, ts=ts, step=step, start=start, rows=rows, gaps=gaps)
    return made.where(F.size("window") == length)


def context_windows(
    df: DataFrame,
    horizon: int,
    context: int = CONTEXT,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    start: str | None = None,
    strict: bool = True,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """The ``context`` values that end ``horizon`` rows before each target row.

    ``strict`` fails the query when a target lacks the full history, otherwise it is skipped.
    """
    names = as_keys(keys)
    reach = horizon + context - 1
    slim = df.select(*names, ts, target)
    if start is not None:
        slim = slim.where(F.col(ts) >= plus_seconds(lit_ts(start), -reach * step))
    made = block_windows(slim, target, reach, horizon, "context", keys=names, ts=ts, step=step, start=start, rows=rows, gaps=gaps)
    whole = F.size("context") == context
    if not strict:
        return made.where(whole)
    message = F.format_string(f"not enough history: need {reach} rows before %s", F.col(ts).cast("string"))
    return made.withColumn("context", F.when(whole, F.col("context")).otherwise(F.raise_error(message)))


def scaler(df: DataFrame, target: str = "y", keys: str | Sequence[str] = "series_id") -> DataFrame:
    """Mean and population deviation of the training rows, per series."""
    train = df.where(F.col("split") == "train")
    return train.groupBy(*as_keys(keys)).agg(F.avg(target).alias("mean"), F.stddev_pop(target).alias("std"))


def standardise(
    df: DataFrame, fitted: DataFrame, target: str = "y", name: str = "scaled", keys: str | Sequence[str] = "series_id"
) -> DataFrame:
    """``(y - mean) / std`` with the training scaler; a constant series keeps scale 1."""
    width = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    return attach(df, fitted, keys).withColumn(name, (F.col(target) - F.col("mean")) / width).drop("mean", "std")


def unstandardise(
    df: DataFrame, fitted: DataFrame, scaled: str = "scaled", name: str = "y_pred", keys: str | Sequence[str] = "series_id"
) -> DataFrame:
    """Inverse of :func:`standardise`."""
    width = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    return attach(df, fitted, keys).withColumn(name, F.col(scaled) * width + F.col("mean")).drop("mean", "std")


def seasonal_difference(
    df: DataFrame,
    period: int = 24,
    target: str = "y",
    name: str = "diff",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """``y - y(period rows earlier)``, undefined rows dropped (``gaps`` as in ``over_neighbours``)."""
    made = over_neighbours(
        df,
        lambda d, over: d.selectExpr("*", f"{quoted(target)} - lag({quoted(target)}, {period}) OVER ({over}) AS {quoted(name)}"),
        keys=keys, ts=ts, step=step, before=period, rows=rows, gaps=gaps,
    )
    return made.where(F.col(name).isNotNull())


def feature_bounds(matrix: DataFrame, features: Sequence[str], keys: str | Sequence[str] = "series_id") -> DataFrame:
    """Min, max and mean of every feature over the training rows: ``(feature, min, max, mean)``."""
    names = as_keys(keys)
    train = matrix.where(F.col("split") == "train")
    made = []
    for c in features:
        v = F.col(c).cast("double")
        made.append(F.struct(F.lit(c).alias("feature"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean")))
    wide = train.groupBy(*names).agg(F.array(*made).alias("__all"))
    return wide.select(*names, F.inline("__all"))


def recent_tail(
    df: DataFrame, length: int = 90 * 24, keys: str | Sequence[str] = "series_id", ts: str = "ts", step: int = HOUR
) -> DataFrame:
    """The last ``length`` grid points of every series."""
    ends = df.groupBy(*as_keys(keys)).agg(F.max(ts).alias("__end"))
    joined = attach(df, ends, keys)
    return joined.where(F.col(ts) > plus_seconds("__end", -length * step)).drop("__end")
