"""Distribution patterns for series that are too long for one task.

A window over ``partitionBy(series)`` puts a whole series into one task. The helpers here
cut the time axis into fixed buckets of ``rows`` grid points, so every task holds a bounded
number of rows however long (or however dominant) one series is:

* ``over_neighbours``  - windows with a bounded look-back / look-ahead (halo rows);
* ``running_offsets``  - what came before / after a bucket, from one row per bucket;
* ``expand``           - integer ranges exploded in chunks spread over all tasks;
* ``attach``           - per-series scalars joined back without gathering a hot series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattgrid.functions.timeaxis import as_keys, quoted, slot_sql

BUCKET = "__bucket"
POSITION = "__position"
STEP = "__step"
BUCKET_ROWS = 4096
CHUNK = 4096
SALTS = 16


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session starts with (before adaptive coalescing)."""
    wide = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(wide or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_rows(reach: int, rows: int | None = None) -> int:
    """Bucket length for a given halo: long enough that halo copies stay below about 1/8."""
    if rows is None:
        return max(BUCKET_ROWS, 8 * reach)
    if rows < reach:
        raise ValueError(f"bucket of {rows} rows is shorter than the halo of {reach}")
    return rows


def bucket_of(ts: str, step: int, rows: int) -> Column:
    """Bucket number of a timestamp: ``rows`` grid points of ``step`` seconds each."""
    return F.expr(f"cast(floor({slot_sql(ts, step)} / {rows}) AS bigint)")


def with_halo(
    df: DataFrame, place: str, *, before: int = 0, after: int = 0, rows: int | None = None
) -> DataFrame:
    """Copy each row into its own bucket and into the neighbours that need to see it.

    ``place`` is SQL text for the row's integer position on the grid. The own bucket is ``floor(place / rows)``.
    """
    width = bucket_rows(max(before, after), rows)
    own = f"cast(floor({place} / {width}) AS bigint)"
    targets = [f"array({own})"]
    if before:
        targets.append(f"if(pmod({place}, {width}) >= {width - before}, array({own} + 1), array())")
    if after:
        targets.append(f"if(pmod({place}, {width}) < {after}, array({own} - 1), array())")
    if len(targets) == 1:
        return df.selectExpr("*", f"{own} AS {BUCKET}")
    return df.selectExpr("*", f"explode(concat({', '.join(targets)})) AS {BUCKET}")


def over_neighbours(
    df: DataFrame,
    build: Callable[[DataFrame, str], DataFrame],
    *,
    keys: str | Sequence[str],
    ts: str,
    step: int,
    before: int = 0,
    after: int = 0,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """Apply window expressions that look at most ``before`` / ``after`` rows away.

    ``build(frame, over)`` adds the columns with ``OVER ({over} ...)`` in SQL text; halo copies are
    dropped afterwards. Frames count rows. ``gaps='fail'`` places rows by their timestamp, which
    needs a gap-free series (``cleaning.to_regular_grid``), and stops the query at a missing step.
    ``gaps='rows'`` places them by their position in the series: exact on series with gaps, at
    the cost of counting the rows of each bucket first.
    """
    if gaps not in ("fail", "rows"):
        raise ValueError(f"gaps must be 'fail' or 'rows', not {gaps!r}")
    width = bucket_rows(max(before, after), rows)
    names = as_keys(keys)
    if gaps == "rows":
        place, source = POSITION, row_positions(df, keys=names, ts=ts, step=step, name=POSITION)
    else:
        place, source = slot_sql(ts, step), df
    spread = with_halo(source, place, before=before, after=after, rows=width)
    over = f"PARTITION BY {', '.join(quoted(k) for k in [*names, BUCKET])} ORDER BY {quoted(ts)}"
    built = build(spread, over)
    own = F.expr(f"{BUCKET} = cast(floor({place} / {width}) AS bigint)")
    if gaps == "rows":
        return built.where(own).drop(BUCKET, POSITION)
    checked = built.selectExpr("*", f"{place} - lag({place}) OVER ({over}) AS {STEP}")
    message = F.format_string("a step is missing before %s; complete the grid or ask for gaps='rows'", F.col(ts).cast("string"))
    whole = F.when(F.col(STEP) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.where(own & whole).drop(BUCKET, STEP)


def by_bucket(
    df: DataFrame, *, keys: str | Sequence[str], ts: str, step: int, rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add the bucket column and place whole buckets on tasks.

    Rows without a key or timestamp belong to no series and are left out. Saying so here gives
    every branch that reads the result the same plan, so the shuffle is done once and reused.
    """
    names = as_keys(keys)
    placed = df.withColumn(BUCKET, bucket_of(ts, step, rows)).dropna(subset=[*names, BUCKET])
    return placed.repartition(*names, BUCKET)


def running_before(column: str | Column, keys: Sequence[str]) -> Column:
    """Sum of ``column`` over all earlier buckets of the series (one row per bucket)."""
    window = (
        Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def expand(
    df: DataFrame, first: str | Column, last: str | Column, name: str, chunk: int = CHUNK
) -> DataFrame:
    """One row per integer in ``[first, last]``.

    A long range is first cut into chunks, the chunks are spread over all tasks, and only then
    turned into rows; the fixed partition count keeps adaptive coalescing from putting the
    (tiny) chunk table back into one task.
    """
    lo, hi = (F.col(c) if isinstance(c, str) else c for c in (first, last))
    chunks = (
        df.withColumn("__lo", lo.cast("bigint"))
        .withColumn("__hi", hi.cast("bigint"))
        .where(F.col("__hi") >= F.col("__lo"))
        .withColumn(
            "__from",
            F.explode(F.sequence(F.col("__lo"), F.col("__hi"), F.lit(chunk).cast("bigint"))),
        )
        .withColumn("__to", F.least(F.col("__from") + (chunk - 1), F.col("__hi")))
        .drop("__lo", "__hi")
    )
    spread = chunks.repartition(shuffle_width(df.sparkSession), *chunks.columns)
    rows = F.explode(F.sequence(F.col("__from"), F.col("__to")))
    return spread.withColumn(name, rows).drop("__from", "__to")


def attach(
    df: DataFrame, scalars: DataFrame, keys: str | Sequence[str], salts: int = SALTS, how: str = "inner"
) -> DataFrame:
    """Join per-key scalars onto rows without sending one hot key to one task.

    ``scalars`` has one row per key. It is copied once per salt; rows pick a salt from their
    content and their input partition, so even identical rows spread out and a retried task
    makes the same choice again. Spark still turns this into a broadcast join on its own when the
    measured size of ``scalars`` is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    names = as_keys(keys)
    salted = scalars.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    plain = [c for c, t in df.dtypes if "map<" not in t]
    spread = F.xxhash64(*plain) + F.spark_partition_id()
    rows = df.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
    return rows.join(salted, [*names, "__salt"], how).drop("__salt")


def row_positions(
    df: DataFrame,
    *,
    keys: str | Sequence[str],
    ts: str,
    step: int,
    name: str = "pos",
    total: str | None = None,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Zero-based position of every row in its series, in ``ts`` order, and the series length.

    Two passes: counts per bucket give the offset, the order inside a bucket gives the rest.
    Exact on series with gaps; timestamps must be unique within a series.
    """
    names = as_keys(keys)
    placed = by_bucket(df, keys=names, ts=ts, step=step, rows=rows)
    counts = placed.groupBy(*names, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    everything = Window.partitionBy(*names)
    offsets = counts.select(
        *names,
        BUCKET,
        running_before("__n", names).alias("__offset"),
        *([F.sum("__n").over(everything).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*names, BUCKET).orderBy(ts)
    return (
        placed.withColumn("__rn", F.row_number().over(inside))
        .join(offsets, [*names, BUCKET])
        .withColumn(name, F.col("__offset") + F.col("__rn") - 1)
        .drop("__rn", "__offset", BUCKET)
    )
