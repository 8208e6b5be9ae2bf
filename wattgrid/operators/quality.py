"""Audit of raw, possibly irregular meter records."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattgrid.functions.timeaxis import MINUTE, as_keys, from_epoch, naive, seconds_between, slot, slot_sql
from wattgrid.plans.buckets import BUCKET, BUCKET_ROWS

VOLTAGE_MIN = 220.0
VOLTAGE_MAX = 250.0
METER_COLUMNS = [
    "Global_active_power",
    "Global_reactive_power",
    "Voltage",
    "Global_intensity",
    "Sub_metering_1",
    "Sub_metering_2",
    "Sub_metering_3",
]


def meter_rules() -> dict[str, Column]:
    """Named conditions that mark a physically implausible meter value."""
    voltage = F.col("Voltage")
    rules = {"voltage_out_of_band": (voltage < VOLTAGE_MIN) | (voltage > VOLTAGE_MAX)}
    for name in ("Global_active_power", "Global_reactive_power", "Global_intensity"):
        rules[f"{name}_negative"] = F.col(name) < 0
    return rules


def missing_report(df: DataFrame, columns: Sequence[str], keys: str | Sequence[str] = ()) -> DataFrame:
    """Missing cells per column, most first (ties by column name), per key if keys are given."""
    names = as_keys(keys)
    counted = df.groupBy(*names).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counted.unpivot(names, list(columns), "column", "n_missing")
    return long.orderBy(*names, F.desc("n_missing"), "column")


def duplicate_timestamps(df: DataFrame, keys: str | Sequence[str] = "series_id", ts: str = "ts") -> DataFrame:
    """Rows whose timestamp the series has already shown."""
    names = as_keys(keys)
    per_ts = df.groupBy(*names, ts).agg(F.count(F.lit(1)).alias("__n"))
    return per_ts.groupBy(*names).agg(F.sum(F.col("__n") - 1).alias("n_duplicated"))


def range_violations(
    df: DataFrame, rules: Mapping[str, Column], keys: str | Sequence[str] = "series_id"
) -> DataFrame:
    """Number of rows that break each named rule; NULL never counts as a violation."""
    return df.groupBy(*as_keys(keys)).agg(*[F.count_if(rule).alias(n) for n, rule in rules.items()])


def _continuity(cells: DataFrame, names: list[str], step: int, sums: Sequence[str]) -> DataFrame:
    """Gap statistics from one row per occupied grid cell.

    Two timestamps in one cell are less than a step apart, so only neighbouring occupied cells
    can enclose a gap. Cells are walked inside buckets, buckets inside the series.
    """
    in_bucket = Window.partitionBy(*names, BUCKET).orderBy("__cell")
    gap = seconds_between(F.lag("__last").over(in_bucket), F.col("__first"))
    buckets = (
        cells.withColumn("__gap", gap)
        .groupBy(*names, BUCKET)
        .agg(
            F.min("__first").alias("__first"),
            F.max("__last").alias("__last"),
            F.count_if(F.col("__gap") > step).alias("__gaps"),
            F.max(F.when(F.col("__gap") > step, F.col("__gap"))).alias("__largest"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    return _series_continuity(buckets, names, step, sums)


def _series_continuity(buckets: DataFrame, names: list[str], step: int, sums: Sequence[str]) -> DataFrame:
    """Gap statistics of a series from one row per bucket."""
    in_series = Window.partitionBy(*names).orderBy(BUCKET)
    edge = seconds_between(F.lag("__last").over(in_series), F.col("__first"))
    span = seconds_between(F.min("__first"), F.max("__last"))
    return (
        buckets.withColumn("__edge", edge)
        .groupBy(*names)
        .agg(
            (F.floor(span / step) + 1).cast("bigint").alias("expected_rows"),
            (F.sum("__gaps") + F.count_if(F.col("__edge") > step)).cast("bigint").alias("n_gaps"),
            (
                F.coalesce(
                    F.greatest(F.max("__largest"), F.max(F.when(F.col("__edge") > step, F.col("__edge")))),
                    F.lit(0.0),
                )
                / MINUTE
            ).alias("largest_gap_minutes"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )


def _cells(df: DataFrame, names: list[str], ts: str, step: int, sums: Mapping[str, Column]) -> DataFrame:
    t = naive(ts)
    keyed = df.withColumn("__cell", slot(ts, step)).withColumn(
        BUCKET, F.floor(F.col("__cell") / BUCKET_ROWS)
    )
    return keyed.groupBy(*names, BUCKET, "__cell").agg(
        F.min(t).alias("__first"), F.max(t).alias("__last"), *[e.alias(n) for n, e in sums.items()]
    )


def timestamp_continuity(
    df: DataFrame, keys: str | Sequence[str] = "series_id", ts: str = "ts", step: int = MINUTE
) -> DataFrame:
    """Departure from the regular grid: expected rows, gaps, largest gap, coverage per series.

    Coverage counts all rows, duplicates included.
    """
    names = as_keys(keys)
    cells = _cells(df, names, ts, step, {"__rows": F.count(F.lit(1))})
    found = _continuity(cells, names, step, ["__rows"])
    return found.select(
        *names,
        "expected_rows",
        "n_gaps",
        "largest_gap_minutes",
        (F.col("__rows") / F.col("expected_rows")).alias("coverage"),
    )


def audit(
    df: DataFrame,
    columns: Sequence[str],
    rules: Mapping[str, Column] | None = None,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = MINUTE,
) -> DataFrame:
    """Every audit figure in one row per series, with a text summary.

    One scan: rows collapse to distinct timestamps, then to grid cells, buckets and series.
    """
    names = as_keys(keys)
    rules = dict(rules or {})
    per_ts = df.groupBy(*names, naive(ts).alias(ts)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns],
        *[F.count_if(rule).alias(n) for n, rule in rules.items()],
    )
    counters = ["n_rows", *[f"missing_{c}" for c in columns], *rules]
    sums = {c: F.sum(c) for c in counters}
    sums["n_duplicated_timestamps"] = F.sum(F.col("n_rows") - 1)
    found = _continuity(_cells(per_ts, names, ts, step, sums), names, step, list(sums))
    return _report(found, names, columns, list(rules))


def _report(found: DataFrame, names: list[str], columns: Sequence[str], rules: Sequence[str]) -> DataFrame:
    missing = sum((F.col(f"missing_{c}") for c in columns), F.lit(0))
    cells = F.col("n_rows") * len(columns)
    report = found.withColumn(
        "missing_rate", F.coalesce(missing / F.nullif(cells, F.lit(0)), F.lit(0.0))
    ).withColumn("coverage", F.col("n_rows") / F.col("expected_rows"))
    broken = F.concat_ws("; ", *[F.format_string(f"{n} in %d rows", F.col(n)) for n in rules]) if rules else F.lit("none checked")
    summary = F.format_string(
        "%,d of %,d expected readings (%.2f percent), %d of them repeat a time. "
        "%d breaks in the grid, the longest lasts %.0f minutes. %.4f percent of the values are empty. Broken rules: %s.",
        F.col("n_rows"), F.col("expected_rows"), F.col("coverage") * 100, F.col("n_duplicated_timestamps"),
        F.col("n_gaps"), F.col("largest_gap_minutes"), F.col("missing_rate") * 100, broken,
    )
    return report.select(
        *names,
        "n_rows",
        *[f"missing_{c}" for c in columns],
        "missing_rate",
        "n_duplicated_timestamps",
        *rules,
        "n_gaps",
        "largest_gap_minutes",
        "expected_rows",
        "coverage",
        summary.alias("summary"),
    )


# Bits of one presence map; the size of Spark's bitmap aggregates.
MAP_BITS = 8 * 4096


def audit_state(
    df: DataFrame,
    columns: Sequence[str],
    rules: Mapping[str, Column] | None = None,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    resolution: int = MINUTE,
) -> DataFrame:
    """The audit as a state that merges: one row per series and bucket of ``MAP_BITS`` times.

    A bucket holds its number of rows, of missing cells and of broken rules, and a bitmap of the times it has
    seen. Store the state of each new file next to the others and read the report from all of
    them with :func:`audit_of_states`; no file is read twice. Times must lie on the ``resolution`` in
    seconds; others stop the query. Rows without a time are counted in a bucket of their own (NULL).
    """
    names = as_keys(keys)
    rules = dict(rules or {})
    place = slot_sql(ts, resolution)
    off_grid = F.format_string("%s is not on the grid of the audit", F.col(ts).cast("string"))
    on_grid = from_epoch(F.expr(f"{place} * {resolution}")) == naive(ts)
    checked = F.when(~on_grid, F.raise_error(off_grid).cast("bigint")).otherwise(F.expr(place))
    placed = df.withColumn("__place", checked)
    return placed.groupBy(*names, F.expr(f"floor(__place / {MAP_BITS})").cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns],
        *[F.count_if(rule).alias(n) for n, rule in rules.items()],
        F.expr(f"bitmap_construct_agg(pmod(__place, {MAP_BITS}))").alias("seen"),
    )


def merge_audit_states(states: DataFrame, keys: str | Sequence[str] = "series_id") -> DataFrame:
    """One state from several of any order: counts add up, bitmaps are united."""
    at = [*as_keys(keys), "bucket"]
    counters = [c for c in states.columns if c not in (*at, "seen")]
    return states.groupBy(*at).agg(*[F.sum(c).alias(c) for c in counters], F.bitmap_or_agg("seen").alias("seen"))


def _map_statistics(maps: Iterator[pa.Array], resolution: int, step: int) -> Iterator[pa.Array]:
    """First and last set bit, number and size of the jumps over ``step`` seconds, number of set bits."""
    names = ("first", "last", "gaps", "largest", "n")
    kind = pa.struct([(n, pa.int64()) for n in names])
    for batch in maps:
        found = []
        for m in batch:
            at = np.flatnonzero(np.unpackbits(np.frombuffer(m.as_py() or b"", np.uint8), bitorder="little"))
            jumps = np.diff(at)
            wide = jumps[jumps * resolution > step]
            ends = (int(at[0]), int(at[-1])) if len(at) else (None, None)
            found.append(dict(zip(names, (*ends, len(wide), int(wide.max()) if len(wide) else None, len(at)))))
        yield pa.array(found, kind)


def audit_of_states(
    states: DataFrame,
    columns: Sequence[str],
    rules: Sequence[str] = (),
    keys: str | Sequence[str] = "series_id",
    step: int = MINUTE,
    resolution: int = MINUTE,
) -> DataFrame:
    """The report of :func:`audit` from any number of states of :func:`audit_state`.

    Bits of a map are walked in the task that holds it; between buckets only ends are compared.
    """
    names = as_keys(keys)
    merged = merge_audit_states(states, names)

    @F.arrow_udf("first long, last long, gaps long, largest long, n long")
    def statistics(maps: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _map_statistics(maps, resolution, step)

    seen = merged.withColumn("__m", statistics(F.col("seen")))

    def time(bit: str) -> Column:
        return from_epoch(F.expr(f"(bucket * {MAP_BITS} + __m.{bit}) * {resolution}"))

    # Rows without a time are equal in it: all but one of them repeat it.
    distinct = F.when(F.col("bucket").isNull(), F.lit(1)).otherwise(F.col("__m.n"))
    counters = ["n_rows", *[f"missing_{c}" for c in columns], *rules]
    buckets = seen.select(
        *names, F.col("bucket").alias(BUCKET), *counters,
        time("first").alias("__first"), time("last").alias("__last"),
        F.col("__m.gaps").alias("__gaps"), (F.col("__m.largest") * resolution).cast("double").alias("__largest"),
        (F.col("n_rows") - distinct).alias("n_duplicated_timestamps"),
    )
    found = _series_continuity(buckets, names, step, [*counters, "n_duplicated_timestamps"])
    return _report(found, names, columns, rules)


def failed_expectations(metrics: DataFrame, expectations: DataFrame) -> DataFrame:
    """Metrics that miss their approved value.

    ``metrics`` is ``(metric, value)``; ``expectations`` is ``(metric, op, expected, rtol)`` with
    op one of ``close``, ``<=``, ``>=``, ``<``, ``>``. A metric that was never computed fails too.
    """
    value, want = F.col("value"), F.col("expected")
    met = (
        F.when(F.col("op") == "close", F.abs(value - want) <= F.lit(1e-8) + F.col("rtol") * F.abs(want))
        .when(F.col("op") == "<=", value <= want)
        .when(F.col("op") == ">=", value >= want)
        .when(F.col("op") == "<", value < want)
        .when(F.col("op") == ">", value > want)
        .otherwise(F.lit(False))
    )
    joined = expectations.join(metrics, "metric", "left")
    return joined.where(~F.coalesce(met, F.lit(False))).select("metric", "op", "expected", "rtol", "value")


def require_expectations(metrics: DataFrame, expectations: DataFrame, shown: int = 20) -> None:
    """Raise when any expectation fails, naming the first few."""
    failed = failed_expectations(metrics, expectations)
    rows = failed.orderBy("metric").take(shown)
    if rows:
        listed = "; ".join(f"{r['metric']}={r['value']} not {r['op']} {r['expected']}" for r in rows)
        raise ValueError(f"expectations failed: {listed}")


def target_mismatches(
    predictions: DataFrame,
    series: DataFrame,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    target: str = "y",
) -> DataFrame:
    """Per model: predicted rows whose stored truth differs from the series at that timestamp."""
    names = as_keys(keys)
    truth = series.select(*names, ts, F.col(target).alias("__actual"))
    joined = predictions.join(truth, [*names, ts], "left")
    return joined.groupBy(*names, "model").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("y_true").eqNullSafe(F.col("__actual"))).alias("n_mismatch"),
    )
