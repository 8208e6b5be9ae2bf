"""Regular grid, length-aware gap filling and hourly roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattgrid.functions.timeaxis import (
    HOUR,
    MINUTE,
    as_keys,
    floor_to,
    naive,
    plus_seconds,
    quoted,
    seconds_between,
    slot,
)
from wattgrid.plans.buckets import BUCKET, BUCKET_ROWS, attach, by_bucket, expand

FILL_LIMIT_MINUTES = 60

# column -> (aggregate, scale): power adds up to energy per hour, levels are averaged
METER_ROLLUP: dict[str, tuple[str, float]] = {
    "Global_active_power": ("sum", 1 / 60),
    "Global_reactive_power": ("sum", 1 / 60),
    "Voltage": ("mean", 1.0),
    "Global_intensity": ("mean", 1.0),
    "Sub_metering_1": ("sum", 1.0),
    "Sub_metering_2": ("sum", 1.0),
    "Sub_metering_3": ("sum", 1.0),
}


def grid_points(df: DataFrame, keys: str | Sequence[str], ts: str, step: int) -> DataFrame:
    """All timestamps ``min, min + step, ... <= max`` of every series."""
    names = as_keys(keys)
    t = naive(ts)
    bounds = df.groupBy(*names).agg(F.min(t).alias("__start"), F.max(t).alias("__end"))
    last = F.floor(seconds_between("__start", "__end") / step)
    points = expand(bounds.withColumn("__last", last).drop("__end"), F.lit(0), "__last", "__k")
    return points.select(*names, plus_seconds("__start", F.col("__k") * step).alias(ts))


def deduplicate(
    df: DataFrame,
    order: str,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first record of every timestamp, first by ``order`` (an ingest ordinal).

    Copies collapse before the shuffle, so a timestamp with very many copies is no hot spot.
    """
    names = as_keys(keys)
    kept = [c for c in (columns or df.columns) if c not in (*names, ts, order)]
    picked = [F.min_by(c, order).alias(c) for c in kept]
    return df.groupBy(*names, ts).agg(*picked, F.min(order).alias(order))


def to_regular_grid(
    df: DataFrame,
    columns: Sequence[str],
    order: str,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = MINUTE,
) -> DataFrame:
    """First record per timestamp on a gap-free grid; absent points become all-NULL rows.

    Records off the grid are dropped. Grid points travel as extra rows through the same
    aggregate that removes duplicates, so completing the grid needs no join.
    """
    names = as_keys(keys)
    records = df.select(*names, naive(ts).alias(ts), *columns, F.col(order).alias("__ord"), F.lit(False).alias("__grid"))
    points = grid_points(df, names, ts, step).withColumn("__grid", F.lit(True))
    merged = records.unionByName(points, allowMissingColumns=True)
    return (
        merged.groupBy(*names, ts)
        .agg(*[F.min_by(c, "__ord").alias(c) for c in columns], F.bool_or("__grid").alias("__grid"))
        .where("__grid")
        .drop("__grid")
    )


def _neighbour_edges(placed: DataFrame, names: list[str], columns: Sequence[str]) -> DataFrame:
    """Per bucket: last valid point before it and first valid point after it, for every column."""
    picks = []
    for c in columns:
        there = f"CASE WHEN {quoted(c)} IS NOT NULL THEN __slot END"
        picks += [
            F.expr(f"min({there}) AS {quoted(c + '__fs')}"),
            F.expr(f"min_by({quoted(c)}, {there}) AS {quoted(c + '__fv')}"),
            F.expr(f"max({there}) AS {quoted(c + '__ls')}"),
            F.expr(f"max_by({quoted(c)}, {there}) AS {quoted(c + '__lv')}"),
        ]
    edges = placed.groupBy(*names, BUCKET).agg(*picks)
    series = ", ".join(quoted(n) for n in names)
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    past = f"(PARTITION BY {series} ORDER BY {BUCKET} {earlier})"
    coming = f"(PARTITION BY {series} ORDER BY {BUCKET} DESC {earlier})"
    out = []
    for c in columns:
        for found, over, name in (("ls", past, "ps0"), ("lv", past, "pv0"), ("fs", coming, "ns0"), ("fv", coming, "nv0")):
            out.append(f"last({quoted(f'{c}__{found}')}, true) OVER {over} AS {quoted(f'{c}__{name}')}")
    return edges.selectExpr(*[quoted(n) for n in names], BUCKET, *out)


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    limit: int = FILL_LIMIT_MINUTES,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = MINUTE,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Fill missing cells of a regular grid by the length of their run.

    Runs of at most ``limit`` points repeat the last value, longer ones are interpolated in time,
    a leading run takes the first value and a long trailing run repeats the last. Neighbours are
    original values only. Each bucket needs just the nearest valid points outside it, so runs
    may span any number of buckets.
    """
    names = as_keys(keys)
    return _fill(by_bucket(df, keys=names, ts=ts, step=step, rows=rows), columns, limit, names, ts, step).drop(BUCKET)


def _fill(
    placed: DataFrame, columns: Sequence[str], limit: int, names: list[str], ts: str, step: int
) -> DataFrame:
    # Positions as doubles: exact far beyond any series, and their arithmetic needs no overflow checks.
    located = placed.withColumn("__slot", slot(ts, step).cast("double"))
    edges = _neighbour_edges(located, names, columns)
    part = f"PARTITION BY {', '.join(quoted(n) for n in names)}, {BUCKET} ORDER BY __slot"
    running = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    seen = []
    for c in columns:
        there = f"CASE WHEN {quoted(c)} IS NOT NULL THEN __slot END"
        for over, mark in ((f"({part} {running})", "p"), (f"({part} DESC {running})", "n")):
            seen.append(f"last({there}, true) OVER {over} AS {quoted(f'{c}__{mark}s')}")
            seen.append(f"last({quoted(c)}, true) OVER {over} AS {quoted(f'{c}__{mark}v')}")
    walked = located.selectExpr("*", *seen).join(edges, [*names, BUCKET])
    marks = [f"{c}__{k}" for c in columns for k in ("pv", "ps", "nv", "ns")]
    # Neighbours become plain columns first: the fill rule names each of them several times.
    resolved = walked.selectExpr(
        *[quoted(c) for c in placed.columns], "__slot", *[f"coalesce({quoted(m)}, {quoted(m + '0')}) AS {quoted(m)}" for m in marks]
    )
    filled = {}
    for c in columns:
        v, pv, ps, nv, ns = (quoted(n) for n in (c, f"{c}__pv", f"{c}__ps", f"{c}__nv", f"{c}__ns"))
        # The line is NULL without both neighbours; then the last value stands, or the first one.
        line = f"{pv} + (cast({nv} AS double) - {pv}) * ((__slot - {ps}) / ({ns} - {ps}))"
        kind = placed.schema[c].dataType.simpleString()
        filled[c] = f"coalesce({v}, if({ns} - {ps} <= {limit + 1}, {pv}, cast({line} AS {kind})), {pv}, {nv}) AS {v}"
    return resolved.selectExpr(*[filled.get(c, quoted(c)) for c in placed.columns])


def missing_runs(
    df: DataFrame,
    column: str,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = MINUTE,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Missing points of a regular grid with the length of the run they belong to.

    The length follows from the nearest valid positions on both sides, or the ends of the series.
    """
    names = as_keys(keys)
    located = by_bucket(df.select(*names, ts, column), keys=names, ts=ts, step=step, rows=rows).withColumn("__slot", slot(ts, step))
    edges = _neighbour_edges(located, names, [column]).select(*names, BUCKET, f"{column}__ps0", f"{column}__ns0")
    ends = located.groupBy(*names).agg(F.min("__slot").alias("__first"), F.max("__slot").alias("__last"))
    part = Window.partitionBy(*names, BUCKET)
    there = F.when(F.col(column).isNotNull(), F.col("__slot"))
    walked = located.select(
        "*",
        F.last(there, ignorenulls=True).over(part.orderBy("__slot")).alias("__ps"),
        F.last(there, ignorenulls=True).over(part.orderBy(F.desc("__slot"))).alias("__ns"),
    )
    joined = attach(walked.where(F.col(column).isNull()).join(edges, [*names, BUCKET]), ends, names)
    before = F.coalesce("__ps", f"{column}__ps0", F.col("__first") - 1)
    after = F.coalesce("__ns", f"{column}__ns0", F.col("__last") + 1)
    return joined.select(*names, ts, (after - before - 1).alias("run_length"))


def _rollup_aggregates(spec: Mapping[str, tuple[str, float]], dtype: str) -> list[Column]:
    aggregates = []
    for c, (how, scale) in spec.items():
        value = F.col(c).cast("double")
        if how == "sum":
            made = F.coalesce(F.sum(value), F.lit(0.0)) * scale
        elif how == "mean":
            made = F.avg(value) * scale
        else:
            raise ValueError(f"unknown aggregate {how!r} for {c}; use 'sum' or 'mean'")
        aggregates.append(made.cast(dtype).alias(c))
    return aggregates


def resample(
    df: DataFrame,
    spec: Mapping[str, tuple[str, float]] = METER_ROLLUP,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    complete: bool = True,
    dtype: str = "float",
) -> DataFrame:
    """Aggregate to ``step`` buckets; with ``complete`` empty buckets between min and max appear.

    An empty bucket has sum 0 and mean NULL. Edge buckets may be partial. Records collapse
    map-side; the empty buckets ride along as extra rows instead of a join.
    """
    names = as_keys(keys)
    bucketed = df.select(*names, floor_to(ts, step).alias(ts), *spec)
    if complete:
        points = grid_points(bucketed.select(*names, ts), names, ts, step)
        bucketed = bucketed.unionByName(points, allowMissingColumns=True)
    return bucketed.groupBy(*names, ts).agg(*_rollup_aggregates(spec, dtype))


def clean_and_resample(
    df: DataFrame,
    order: str,
    spec: Mapping[str, tuple[str, float]] = METER_ROLLUP,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = MINUTE,
    to: int = HOUR,
    limit: int = FILL_LIMIT_MINUTES,
    dtype: str = "float",
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Grid, gap fill and roll-up in one plan.

    Fill buckets are cut on roll-up boundaries, so the roll-up reuses the fill's partitioning and
    needs no further shuffle.
    """
    if to % step:
        raise ValueError(f"roll-up step {to}s is not a multiple of the grid step {step}s")
    names = as_keys(keys)
    per = to // step
    aligned = max(1, round(rows / per)) * per
    columns = list(spec)
    grid = to_regular_grid(df, columns, order, names, ts, step)
    placed = by_bucket(grid, keys=names, ts=ts, step=step, rows=aligned)
    filled = _fill(placed, columns, limit, names, ts, step)
    hourly = filled.groupBy(*names, BUCKET, floor_to(ts, to).alias("__hour")).agg(*_rollup_aggregates(spec, dtype))
    return hourly.select(*names, F.col("__hour").alias(ts), *columns)
