"""Ranks, cumulative counts and exact quantiles of a group of any size.

``rank() over (partition by group order by value)`` and the exact ``percentile`` aggregate both
hold a whole group in one task. Here equal values are counted first (map-side), the value axis
of a big group is cut into ranges at sampled cut points, and a group total per range gives every
range its offset. The cut points only balance the work; results do not depend on them. They are
chosen by hash, so a recomputed branch of the plan finds the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattgrid.functions.timeaxis import as_keys
from wattgrid.plans.buckets import attach
from wattgrid.session import staged

RANGE = "__range"
RANGES = 512
ROWS_PER_RANGE = 65536
SMALL_GROUP = 8 * RANGES


def _cut_points(counts: DataFrame, keys: list[str], value: str, ranges: int, small: int) -> DataFrame:
    """Sorted cut points per group: the lowest-hashed value of each of ``ranges`` hash classes."""
    hashed = counts.select(*keys, value, F.xxhash64(value).alias("__h"))
    classes = hashed.groupBy(*keys, F.pmod("__h", F.lit(ranges)).alias("__class")).agg(
        F.min_by(value, "__h").alias("__cut"), F.count(F.lit(1)).alias("__n")
    )
    return classes.groupBy(*keys).agg(
        F.array_sort(F.collect_list("__cut")).alias("__all"), F.sum("__n").alias("__rows")
    ).select(
        *keys,
        F.when(F.col("__rows") > small, F.col("__all")).otherwise(F.slice("__all", 1, 0)).alias("__cuts"),
    )


def with_range(
    counts: DataFrame,
    keys: str | Sequence[str],
    value: str,
    *,
    ranges: int = RANGES,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the value range of each row: number of cut points below the value."""
    names = as_keys(keys)
    return _located(counts, _cut_points(counts, names, value, ranges, rows_per_range), names, value, ranges)


def _located(rows: DataFrame, cuts: DataFrame, names: list[str], value: str, ranges: int) -> DataFrame:
    rows = attach(rows, cuts, names).withColumn(RANGE, F.lit(0))
    jump = 1
    while jump * 2 <= ranges:
        jump *= 2
    while jump:
        probe = F.get("__cuts", F.col(RANGE) + (jump - 1))
        step = F.when(probe < F.col(value), F.lit(jump)).otherwise(F.lit(0))
        rows = rows.withColumn(RANGE, F.col(RANGE) + step)
        jump //= 2
    return rows.drop("__cuts")


def cumulative(
    counts: DataFrame,
    keys: str | Sequence[str],
    value: str,
    count: str = "n",
    *,
    ranges: int = RANGES,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``upto`` (rows with a value <= this one), ``ties`` (rows with this value) and ``total``.

    ``counts`` holds pre-aggregated rows ``(keys, value, [more], count)``.
    """
    names = as_keys(keys)
    ranged = with_range(counts, names, value, ranges=ranges, rows_per_range=rows_per_range)
    placed = ranged.repartition(*names, RANGE)
    totals = placed.groupBy(*names, RANGE).agg(F.sum(count).alias("__sum"))
    over_ranges = Window.partitionBy(*names).orderBy(RANGE)
    offsets = totals.select(
        *names,
        RANGE,
        (F.sum("__sum").over(over_ranges) - F.col("__sum")).alias("__offset"),
        F.sum("__sum").over(Window.partitionBy(*names)).alias("total"),
    )
    ordered = Window.partitionBy(*names, RANGE).orderBy(value)
    peers = Window.partitionBy(*names, RANGE, value)
    running = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("__upto", F.sum(count).over(running))
        .withColumn("ties", F.sum(count).over(peers))
        .join(offsets, [*names, RANGE])
        .withColumn("upto", F.col("__upto") + F.col("__offset"))
        .drop("__upto", "__offset", RANGE)
    )


def quantile_table(
    cumulated: DataFrame, keys: str | Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, columns ``q0, q1, ...``.

    Works on :func:`cumulative` output: the two neighbours of each quantile position are the rows
    whose cumulative interval covers it, picked by conditional aggregates.
    """
    names = as_keys(keys)
    below = F.col("upto") - F.col("ties")
    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        position = F.lit(p) * (F.col("total") - 1)
        low, high = F.floor(position), F.ceil(position)
        picks.append(F.max(F.when((below <= low) & (low < F.col("upto")), F.col(value))).alias(f"__lo{i}"))
        picks.append(F.max(F.when((below <= high) & (high < F.col("upto")), F.col(value))).alias(f"__hi{i}"))
    found = cumulated.groupBy(*names).agg(F.max("total").alias("n"), *picks)
    columns = []
    for i, p in enumerate(probabilities):
        position = F.lit(p) * (F.col("n") - 1)
        weight = position - F.floor(position)
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        columns.append((lo + (hi - lo) * weight).alias(f"q{i}"))
    return found.select(*names, "n", *columns)


def exact_quantiles(
    rows: DataFrame,
    keys: str | Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    ranges: int = RANGES,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """:func:`quantile_table` of plain rows, without counting every value or moving every row.

    Groups of more than ``small`` rows are cut into value ranges and the rows of each range are counted;
    values are then counted only in the ranges that hold a neighbour of a quantile position. Tasks keep an
    entry per group and range, and few of the rows. ``rows`` is read three times. The tables between the
    passes have a few rows per group and are stored, so that the planner knows their size and joins small
    ones where the rows are read. Rows with a NULL key or value are left out.
    """
    names = as_keys(keys)
    slim = rows.select(*names, value).where(F.col(value).isNotNull())
    ranged = _located(slim, staged(_cut_points(slim, names, value, ranges, small)), names, value, ranges)
    totals = ranged.groupBy(*names, RANGE).agg(F.count(F.lit(1)).alias("__sum"))
    upto = F.sum("__sum").over(Window.partitionBy(*names).orderBy(RANGE))
    offsets = totals.select(
        *names, RANGE, "__sum", (upto - F.col("__sum")).alias("__offset"), F.sum("__sum").over(Window.partitionBy(*names)).alias("total")
    )
    held = F.lit(False)
    for p in probabilities:
        position = F.lit(p) * (F.col("total") - 1)
        for at in (F.floor(position), F.ceil(position)):
            held = held | ((F.col("__offset") <= at) & (at < F.col("__offset") + F.col("__sum")))
    wanted = staged(offsets.where(held).drop("__sum"))
    counts = attach(ranged, wanted, [*names, RANGE]).groupBy(*names, RANGE, "__offset", "total", value).agg(F.count(F.lit(1)).alias("ties"))
    running = F.sum("ties").over(Window.partitionBy(*names, RANGE).orderBy(value))
    cumulated = counts.withColumn("upto", F.col("__offset") + running)
    return staged(quantile_table(cumulated, names, value, probabilities))
