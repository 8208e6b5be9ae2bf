"""Input series built from the given tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattgrid.functions.timeaxis import DAY, HOUR
from wattgrid.operators import cleaning, features, forecast
from wattgrid.operators.quality import METER_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

TEST_START = "2024-01-24"
DAILY_TEST_START = "2001-01-01"
GAP_LIMIT = 2
METER_SERIES = METER_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw irregular records: one series per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"), "ts", F.col("value").alias("y"), "event_id"
    )


RECORDS = "records AS (SELECT event_type AS series_id, ts, value AS y, event_id FROM events)"


def minute_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records on whole minutes, a NULL wherever the event id is a multiple of 7."""
    raw = records(spark, sf_dir)
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return raw.select(
        "series_id", minute.alias("ts"), F.when(F.col("event_id") % 7 != 0, F.col("y")).alias("y"), "event_id"
    )


MINUTES = (
    "minutes AS (SELECT event_type AS series_id, date_trunc('minute', ts) AS ts, "
    "CASE WHEN event_id % 7 <> 0 THEN value END AS y, event_id FROM events)"
)


def hourly_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sums where the hour has records."""
    rolled = cleaning.resample(records(spark, sf_dir), {"y": ("sum", 1.0)}, step=HOUR, complete=False, dtype="double")
    return rolled.withColumn("y", F.round("y", 2))


GAPPY = f"""{RECORDS}, gappy AS (
    SELECT series_id, date_trunc('hour', ts) AS ts, round(sum(y), 2) AS y FROM records GROUP BY 1, 2)"""


def on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    gappy = hourly_gappy(spark, sf_dir).withColumn("first", F.lit(0))
    return cleaning.to_regular_grid(gappy, ["y"], "first", step=HOUR)


GRID = f"""{GAPPY}, bounds AS (SELECT series_id, min(ts) AS a, max(ts) AS z FROM gappy GROUP BY 1),
points AS (SELECT series_id, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ts FROM bounds),
grid AS (SELECT series_id, ts, y FROM points LEFT JOIN gappy USING (series_id, ts))"""


def fill_sql(source: str, name: str, columns: list[str], limit: int) -> str:
    """CTEs that fill ``columns`` of a gridded CTE by run length."""
    back = "OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    found, filled = [], []
    for c in columns:
        at = f"CASE WHEN {c} IS NOT NULL THEN rn END"
        found.append(
            f"last_value({c} IGNORE NULLS) {back} AS {c}_pv, last_value({at} IGNORE NULLS) {back} AS {c}_pr, "
            f"first_value({c} IGNORE NULLS) {ahead} AS {c}_nv, first_value({at} IGNORE NULLS) {ahead} AS {c}_nr"
        )
        filled.append(
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pv IS NULL THEN {c}_nv "
            f"WHEN {c}_nv IS NULL OR {c}_nr - {c}_pr - 1 <= {limit} THEN {c}_pv "
            f"ELSE {c}_pv + (CAST({c}_nv AS DOUBLE) - {c}_pv) * ((rn - {c}_pr) / ({c}_nr - {c}_pr)) END AS {c}"
        )
    return f"""{name}_n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS rn FROM {source}),
{name}_s AS (SELECT *, {", ".join(found)} FROM {name}_n),
{name} AS (SELECT series_id, ts, rn, {", ".join(filled)} FROM {name}_s)"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free hourly series per event type."""
    return cleaning.fill_gaps(on_grid(spark, sf_dir), ["y"], GAP_LIMIT, step=HOUR)


HOURLY = f"{GRID}, {fill_sql('grid', 'hourly', ['y'], GAP_LIMIT)}"


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly features with split, warm-up removed."""
    made = features.build_features(hourly(spark, sf_dir))
    return features.drop_warmup(features.chronological_split(made, TEST_START))


EASTER = """easter_a AS (SELECT y0, y0 % 19 AS a, y0 // 100 AS b, y0 % 100 AS c FROM (SELECT unnest(range(1990, 2031)) AS y0)),
easter_h AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM easter_a),
easter_l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM easter_h),
easter AS (SELECT y0, make_date(y0, n // 31, n % 31 + 1) AS d FROM (
    SELECT y0, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM easter_l)),
holidays AS (
    SELECT DISTINCT make_date(y0, m, k) AS d FROM easter, (VALUES (1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25)) AS f(m, k)
    UNION SELECT (d + INTERVAL 1 DAY)::DATE FROM easter UNION SELECT (d + INTERVAL 39 DAY)::DATE FROM easter
    UNION SELECT (d + INTERVAL 50 DAY)::DATE FROM easter WHERE y0 NOT BETWEEN 2005 AND 2007)"""

CALENDAR_SQL = """CAST(hour(ts) AS SMALLINT) AS hour, CAST(isodow(ts) - 1 AS SMALLINT) AS dayofweek,
    CAST(day(ts) AS SMALLINT) AS day, CAST(month(ts) AS SMALLINT) AS month, CAST(quarter(ts) AS SMALLINT) AS quarter,
    CAST(year(ts) AS SMALLINT) AS year, CAST(isodow(ts) >= 6 AS TINYINT) AS is_weekend"""


def r(column: str, digits: int = 6, source: str | None = None) -> str:
    """Rounded column for the value comparison; adding zero removes a negative zero."""
    return f"round({source or column}, {digits}) + 0.0 AS {column}"


CYCLES_SQL = ", ".join(
    f"{fn}(2 * pi() * {part} / {period}) AS {name}_{fn}"
    for name, part, period in (("hour", "hour(ts)", 24), ("dayofweek", "(isodow(ts) - 1)", 7), ("month", "month(ts)", 12))
    for fn in ("sin", "cos")
)
HOLIDAY_SQL = "CAST(CAST(ts AS DATE) IN (SELECT d FROM holidays) AS TINYINT) AS is_holiday"


def lag_sql(lags: list[int] = features.LAGS) -> str:
    return ", ".join(f"lag(y, {k}) OVER w AS lag_{k}" for k in lags)


def roll_sql(windows: list[int] = features.ROLLING_WINDOWS) -> str:
    parts = []
    for w in windows:
        frame = f"OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        parts.append(f"CASE WHEN count(y) {frame} = {w} THEN avg(y) {frame} END AS roll_mean_{w}")
        parts.append(f"CASE WHEN count(y) {frame} = {w} THEN stddev_samp(y) {frame} END AS roll_std_{w}")
    return ", ".join(parts)


HISTORY = [f"lag_{k}" for k in features.LAGS] + [
    f"roll_{m}_{w}" for w in features.ROLLING_WINDOWS for m in ("mean", "std")
]
BUILT = f"""{HOURLY}, {EASTER}, built AS (SELECT series_id, ts, y, {CALENDAR_SQL}, {CYCLES_SQL}, {lag_sql()}, {roll_sql()}, {HOLIDAY_SQL}
    FROM hourly WINDOW w AS (PARTITION BY series_id ORDER BY ts))"""
FEATURED = f"""{BUILT}, featured AS (
    SELECT *, CASE WHEN ts < TIMESTAMP '{TEST_START}' THEN 'train' ELSE 'test' END AS split FROM built
    WHERE {" AND ".join(f"{c} IS NOT NULL" for c in HISTORY)})"""


def naive_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly naive forecasts of the test rows."""
    return forecast.naive_forecasts(featured(spark, sf_dir))


NAIVE = f"""{FEATURED}, naive AS (
    SELECT series_id, 'naive_lag' || k AS model, 'h=1' AS horizon, ts, y AS y_true,
        CASE k WHEN 1 THEN lag_1 WHEN 24 THEN lag_24 ELSE lag_168 END AS y_pred
    FROM featured, (VALUES (1), (24), (168)) AS l(k) WHERE split = 'test')"""


def sales_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-like rows at volume: price paid against list price times quantity."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    joined = items.join(parts, items.l_partkey == parts.p_partkey)
    return joined.select(
        F.col("l_linestatus").alias("series_id"),
        F.col("l_returnflag").alias("model"),
        F.when(F.col("l_linenumber") % 2 == 0, "h=24").otherwise("h=1").alias("horizon"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        F.col("l_extendedprice").alias("y_true"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("y_pred"),
    )


SALES = """sales AS (
    SELECT l_linestatus AS series_id, l_returnflag AS model, CASE WHEN l_linenumber % 2 = 0 THEN 'h=24' ELSE 'h=1' END AS horizon,
        l_shipdate AS ts, l_extendedprice AS y_true, l_quantity * p_retailprice AS y_pred
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free daily order value per priority; days without orders are 0."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"), F.col("o_totalprice").alias("y")
    )
    return cleaning.resample(orders, {"y": ("sum", 1.0)}, step=DAY, dtype="double").withColumn("y", F.round("y", 2))


DAILY = """daily_s AS (SELECT o_orderpriority AS series_id, date_trunc('day', o_orderdate) AS ts, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2),
daily_p AS (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM daily_s GROUP BY 1),
daily AS (SELECT series_id, CAST(ts AS TIMESTAMP) AS ts, round(coalesce(y, 0), 2) AS y FROM daily_p LEFT JOIN daily_s USING (series_id, ts))"""


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute records in the meter layout, derived from the events: seven channels with faults."""
    e = table(spark, sf_dir, "events")
    v, i = F.col("value"), F.col("event_id")
    there = i % 11 != 0
    return e.select(
        F.col("event_type").alias("series_id"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"),
        F.when(there, (v / 100 - 0.2)).cast("float").alias("Global_active_power"),
        F.when(there, (v / 1000)).cast("float").alias("Global_reactive_power"),
        F.when(there, (F.lit(215) + v % 40)).cast("float").alias("Voltage"),
        F.when(i % 13 != 0, (v / 20)).cast("float").alias("Global_intensity"),
        (i % 3).cast("float").alias("Sub_metering_1"),
        (i % 5).cast("float").alias("Sub_metering_2"),
        F.when(i % 17 != 0, (i % 19).cast("float")).alias("Sub_metering_3"),
        F.col("event_id").alias("ingest_ord"),
    )


METER = """meter AS (SELECT event_type AS series_id, date_trunc('minute', ts) AS ts,
    CASE WHEN event_id % 11 <> 0 THEN CAST(value / 100 - 0.2 AS FLOAT) END AS Global_active_power,
    CASE WHEN event_id % 11 <> 0 THEN CAST(value / 1000 AS FLOAT) END AS Global_reactive_power,
    CASE WHEN event_id % 11 <> 0 THEN CAST(215 + value % 40 AS FLOAT) END AS Voltage,
    CASE WHEN event_id % 13 <> 0 THEN CAST(value / 20 AS FLOAT) END AS Global_intensity,
    CAST(event_id % 3 AS FLOAT) AS Sub_metering_1, CAST(event_id % 5 AS FLOAT) AS Sub_metering_2,
    CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 19 AS FLOAT) END AS Sub_metering_3, event_id AS ingest_ord FROM events)"""


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every floating column for the value comparison with SQL."""
    made = {}
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            made[name] = F.round(F.col(name).cast("double"), special.get(name, digits)) + F.lit(0.0)
    return df.withColumns(made) if made else df
