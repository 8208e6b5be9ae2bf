"""Sources, sinks, audit and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattgrid.functions.timeaxis import HOUR
from wattgrid.operators import cleaning, quality
from wattgrid.session import scratch_path
from wattgrid.sources import meter_text, tables
from wattgrid.workload import base as b

METERS = b.METER_SERIES
RULES_SQL = """count(*) FILTER (WHERE Voltage < 220 OR Voltage > 250) AS voltage_out_of_band,
    count(*) FILTER (WHERE Global_active_power < 0) AS Global_active_power_negative,
    count(*) FILTER (WHERE Global_reactive_power < 0) AS Global_reactive_power_negative,
    count(*) FILTER (WHERE Global_intensity < 0) AS Global_intensity_negative"""


# --- sources and sinks ------------------------------------------------------------------------


def _meter_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = b.meter(spark, sf_dir)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in METERS}
    return made.select(
        F.date_format("ts", "d/M/yyyy").alias("Date"), F.date_format("ts", "H:mm:ss").alias("Time"),
        *[e.alias(c) for c, e in text.items()],
    )


def read_meter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "meter-text")
    _meter_text_lines(spark, sf_dir).write.option("sep", ";").option("header", True).csv(path)
    read = meter_text.read_meter_text(spark, path)
    return b.rounded(read.select("series_id", "ts", *METERS), 4)


def compose_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = b.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "d/M/yyyy").alias("Date"),
        F.when(F.col("event_id") % 10 == 3, F.lit("25:61:00")).otherwise(F.date_format("ts", "H:mm:ss")).alias("Time"),
    )
    return meter_text.with_timestamp(text, on_bad="quarantine")


def file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meter_text.file_digests(spark, f"{sf_dir}/*.parquet")


def digests_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file per event type, its lines in order of id, read 1,000 bytes at a time."""
    line = F.concat_ws(";", F.col("event_id").cast("string"), "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    lines = b.table(spark, sf_dir, "events").select("event_type", "event_id", line.alias("value"))
    path = scratch_path(spark, "digests")
    placed = lines.repartition("event_type").sortWithinPartitions("event_type", "event_id")
    placed.select("event_type", "value").write.partitionBy("event_type").text(path)
    found = meter_text.file_digests(spark, f"{path}/*", whole_below=0, chunk=1000)
    return found.select(F.regexp_extract("path", "event_type=([^/]+)/", 1).alias("event_type"), "length", "digest")


def read_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = tables.read_stage(spark, f"{sf_dir}/lineitem.parquet")
    return stage.select("l_orderkey", "l_linenumber", "l_shipdate")


def read_prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "prediction-files")
    made = b.sales_predictions(spark, sf_dir)
    for name in ("A", "N", "R"):
        made.where(F.col("model") == name).select("ts", "y_true", "y_pred").write.parquet(f"{folder}/{name}.parquet")
    read = tables.read_prediction_files(spark, folder)
    return b.rounded(read.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.avg("y_true").alias("mean_true")), 4)


def save_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.save_hourly(b.hourly(spark, sf_dir), scratch_path(spark, "hourly"))
    return b.rounded(tables.read_stage(spark, path).select("series_id", "ts", "y"))


def save_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.save_features(b.featured(spark, sf_dir), scratch_path(spark, "features"), ["split"])
    return b.rounded(tables.read_stage(spark, path).select("series_id", "ts", "split", "y", "lag_24", "roll_std_24"))


def save_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    naive = b.naive_predictions(spark, sf_dir)
    for name in ("naive_lag1", "naive_lag24", "naive_lag168"):
        part = naive.where(F.col("model") == name)
        for horizon in ("h=1", "h=24"):
            tables.save_predictions(part, part, path, name, horizon)
    return b.rounded(tables.read_predictions(spark, path).select("series_id", "model", "horizon", "ts", "y_true", "y_pred"))


def reuse_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    sales = b.sales_predictions(spark, sf_dir).groupBy("series_id", "ts").agg(
        F.sum("y_true").alias("y_true"), F.sum("y_pred").alias("y_pred")
    )
    tables.save_predictions(sales, sales, path, "list_price")
    other = sales.withColumn("y_pred", F.lit(0.0))
    # The stored horizon is kept, the other one is written.
    for horizon in ("h=1", "h=24"):
        tables.save_predictions(sales, other, path, "list_price", horizon, if_exists="reuse")
    return b.rounded(tables.read_predictions(spark, path).select("series_id", "horizon", "ts", "y_true", "y_pred"), 2)


def unchanged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    sales = b.sales_predictions(spark, sf_dir).groupBy("series_id", "ts").agg(
        F.sum("y_true").alias("y_true"), F.sum("y_pred").alias("y_pred")
    )
    sales = sales.withColumns({c: F.round(c, 2) for c in ("y_true", "y_pred")})
    other = sales.withColumn("y_pred", F.lit(0.0))
    # Same inputs and parameters: kept. Other parameters: written again.
    for forecast, setting in ((sales, 1), (other, 1)):
        tables.save_predictions(sales, forecast, path, "list_price", "h=1", if_exists="unchanged", inputs=[sales], parameters={"n": setting})
    for forecast, setting in ((sales, 1), (other, 2)):
        tables.save_predictions(sales, forecast, path, "list_price", "h=24", if_exists="unchanged", inputs=[sales], parameters={"n": setting})
    return b.rounded(tables.read_predictions(spark, path).select("series_id", "horizon", "ts", "y_true", "y_pred"), 2)


def save_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.audit(b.meter(spark, sf_dir), METERS, quality.meter_rules()).select(
        "series_id", F.struct("n_rows", "n_gaps").alias("counts"), "expected_rows"
    )
    path = tables.save_summary(found, scratch_path(spark, "summary"))
    read = tables.read_summary(spark, path, found.schema)
    return read.select("series_id", "counts.n_rows", "counts.n_gaps", "expected_rows")


def prediction_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = b.sales_predictions(spark, sf_dir).groupBy("series_id", "ts").agg(F.sum("y_pred").alias("y_pred"))
    moved = sales.withColumn("y_pred", F.when(F.day("ts") == 7, F.col("y_pred") * 1.01).otherwise(F.col("y_pred") * 1.00001))
    return tables.prediction_differences(sales, moved)


# --- audit ------------------------------------------------------------------------------------


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_report(b.meter(spark, sf_dir), METERS, "series_id")


def duplicate_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_timestamps(b.meter(spark, sf_dir))


def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_violations(b.meter(spark, sf_dir), quality.meter_rules())


def timestamp_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(quality.timestamp_continuity(b.records(spark, sf_dir)))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(quality.audit(b.meter(spark, sf_dir), METERS, quality.meter_rules()).drop("summary"))


def audit_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of three interleaved parts, stored one after the other, read as one report."""
    records, rules, path = b.meter(spark, sf_dir), quality.meter_rules(), scratch_path(spark, "audit")
    for part in range(3):
        quality.audit_state(records.where(F.col("ingest_ord") % 3 == part), METERS, rules).write.mode("append").parquet(path)
    return b.rounded(quality.audit_of_states(spark.read.parquet(path), METERS, list(rules)).drop("summary"))


def failed_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.audit(b.records(spark, sf_dir), ["y"], {"large": F.col("y") > 400})
    metrics = found.select(
        F.inline(F.array(*[
            F.struct(F.concat("series_id", F.lit(f"/{n}")).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in ("n_rows", "large", "coverage")
        ]))
    )
    wanted = b.records(spark, sf_dir).groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(F.array(
            F.struct(F.concat("series_id", F.lit("/n_rows")).alias("metric"), F.lit("close").alias("op"), (F.col("n") * 1.04).alias("expected"), F.lit(0.05).alias("rtol")),
            F.struct(F.concat("series_id", F.lit("/large")).alias("metric"), F.lit("<=").alias("op"), F.lit(0.0).alias("expected"), F.lit(0.0).alias("rtol")),
            F.struct(F.concat("series_id", F.lit("/unknown")).alias("metric"), F.lit(">").alias("op"), F.lit(0.0).alias("expected"), F.lit(0.0).alias("rtol")),
        ))
    )
    return b.rounded(quality.failed_expectations(metrics, wanted))


def target_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = b.hourly(spark, sf_dir)
    predictions = b.naive_predictions(spark, sf_dir)
    shifted = predictions.withColumn("y_true", F.when(F.hour("ts") == 3, F.col("y_true") + 1).otherwise(F.col("y_true")))
    return quality.target_mismatches(shifted, series)


# --- cleaning ---------------------------------------------------------------------------------


def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("series_id"), F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_ord"), F.col("l_extendedprice").alias("y"), "l_quantity", "l_partkey",
    )
    ordered = raw.withColumn("ingest_ord", F.col("ingest_ord") * 1000000 + F.col("l_partkey"))
    return cleaning.deduplicate(ordered.groupBy("series_id", "ts", "ingest_ord").agg(F.min("y").alias("y"), F.min("l_quantity").alias("quantity")), "ingest_ord")


def to_regular_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.to_regular_grid(b.minute_records(spark, sf_dir), ["y"], "event_id")


def run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the missing run each missing hour belongs to."""
    return cleaning.missing_runs(b.on_grid(spark, sf_dir), "y", step=HOUR)


def fill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(b.hourly(spark, sf_dir))


def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(cleaning.resample(b.meter(spark, sf_dir), dtype="double"), 5)


def clean_and_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cleaning.clean_and_resample(b.meter(spark, sf_dir), "ingest_ord", dtype="double")
    return b.rounded(made, 3)


# --- SQL --------------------------------------------------------------------------------------

METER_GRID = f"""{b.METER}, ends AS (SELECT series_id, min(ts) AS a, max(ts) AS z FROM meter GROUP BY 1),
firsts AS (SELECT * FROM meter QUALIFY row_number() OVER (PARTITION BY series_id, ts ORDER BY ingest_ord) = 1),
points AS (SELECT series_id, unnest(generate_series(a, z, INTERVAL 1 MINUTE)) AS ts FROM ends),
grid AS (SELECT series_id, ts, {", ".join(METERS)} FROM points LEFT JOIN firsts USING (series_id, ts))"""
_ROLL = {c: f"coalesce(sum({c}), 0)" if how == "sum" else f"avg({c})" for c, (how, _) in cleaning.METER_ROLLUP.items()}


def _roll(digits: int) -> str:
    return ", ".join(
        b.r(c, digits, f"{_ROLL[c]}{' / 60' if scale != 1 else ''}") for c, (_, scale) in cleaning.METER_ROLLUP.items()
    )


_CAST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in METERS)
CONTINUITY = f"""steps AS (SELECT *, date_diff('microsecond', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts) / 1e6 AS d FROM {{source}}),
cont AS (SELECT series_id, count(*) AS n_rows,
    CAST(floor(date_diff('microsecond', min(ts), max(ts)) / 60e6) AS BIGINT) + 1 AS expected_rows,
    count(*) FILTER (WHERE d > 60) AS n_gaps, coalesce(max(d) FILTER (WHERE d > 60), 0) / 60 AS largest_gap_minutes FROM steps GROUP BY 1)"""

_AUDIT_SQL = f"""WITH {b.METER}, {CONTINUITY.format(source='meter')}, counts AS (SELECT series_id,
        {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}' for c in METERS)},
        count(*) - count(DISTINCT ts) AS n_duplicated_timestamps, {RULES_SQL} FROM meter GROUP BY 1)
    SELECT series_id, n_rows, {', '.join(f'missing_{c}' for c in METERS)},
        {b.r('missing_rate', 6, '(' + ' + '.join(f'missing_{c}' for c in METERS) + f') / (n_rows * {len(METERS)})')},
        n_duplicated_timestamps, voltage_out_of_band, Global_active_power_negative, Global_reactive_power_negative,
        Global_intensity_negative, n_gaps, {b.r('largest_gap_minutes')}, expected_rows, {b.r('coverage', 6, 'n_rows / expected_rows')}
    FROM cont JOIN counts USING (series_id)"""

_REUSE_SQL = f"""WITH {b.SALES}, s AS (SELECT series_id, ts, sum(y_true) AS y_true, sum(y_pred) AS y_pred FROM sales GROUP BY 1, 2)
    SELECT series_id, 'h=1' AS horizon, ts, {b.r('y_true', 2)}, {b.r('y_pred', 2)} FROM s
    UNION ALL SELECT series_id, 'h=24', ts, {b.r('y_true', 2)}, 0.0 FROM s"""


QUERIES: dict[str, tuple[b.Query, str | None]] = {
    "src1_read_meter_text": (
        read_meter_text,
        f"WITH {b.METER} SELECT 'meter' AS series_id, ts, {', '.join(b.r(c, 4, f'CAST({c} AS DOUBLE)') for c in METERS)} FROM meter",
    ),
    "src2_compose_timestamp": (
        compose_timestamp,
        "SELECT CASE WHEN event_id % 10 <> 3 THEN date_trunc('second', ts) END AS ts, event_id FROM events",
    ),
    "src3_file_digests": (file_digests, None),
    "src3_digests_in_chunks": (
        digests_in_chunks,
        """SELECT event_type, CAST(sum(length(line)) AS BIGINT) AS length, sha256(string_agg(line, '' ORDER BY event_id)) AS digest FROM (
            SELECT event_type, event_id, event_id || ';' || event_type || ';' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) AS line FROM events) GROUP BY 1""",
    ),
    "src4_read_stage": (
        read_stage,
        "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem",
    ),
    "src5_read_prediction_files": (
        read_prediction_files,
        f"WITH {b.SALES} SELECT model, count(*) AS n, {b.r('mean_true', 4, 'avg(y_true)')} FROM sales GROUP BY model",
    ),
    "snk1_save_hourly": (save_hourly, f"WITH {b.HOURLY} SELECT series_id, ts, {b.r('y')} FROM hourly"),
    "snk2_save_features": (
        save_features,
        f"WITH {b.FEATURED} SELECT series_id, ts, split, {b.r('y')}, {b.r('lag_24')}, {b.r('roll_std_24')} FROM featured",
    ),
    "snk3_save_predictions": (
        save_predictions,
        f"WITH {b.NAIVE} SELECT series_id, model, h.horizon, ts, {b.r('y_true')}, {b.r('y_pred')} "
        "FROM naive, (SELECT 'h=1' AS horizon UNION ALL SELECT 'h=24') h",
    ),
    "snk4_save_summary": (
        save_summary,
        f"WITH {b.METER}, {CONTINUITY.format(source='meter')} SELECT series_id, n_rows, n_gaps, expected_rows FROM cont",
    ),
    "snk5_prediction_differences": (
        prediction_differences,
        f"WITH {b.SALES}, s AS (SELECT series_id, ts, sum(y_pred) AS p FROM sales GROUP BY 1, 2) "
        "SELECT count(*) AS n_rows, count(*) FILTER (WHERE day(ts) = 7 AND p * 0.01 > 1e-4 + 1e-4 * p * 1.01) AS n_different FROM s",
    ),
    "snk6_reuse_predictions": (reuse_predictions, _REUSE_SQL),
    "snk6_unchanged_predictions": (unchanged_predictions, _REUSE_SQL),
    "dq1_missing_report": (
        missing_report,
        f"""WITH {b.METER}, wide AS (SELECT series_id, {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}' for c in METERS)} FROM meter GROUP BY 1)
        SELECT series_id, "column", n_missing FROM (UNPIVOT wide ON {', '.join(METERS)} INTO NAME "column" VALUE n_missing)""",
    ),
    "dq2_duplicate_timestamps": (
        duplicate_timestamps,
        f"WITH {b.METER} SELECT series_id, count(*) - count(DISTINCT ts) AS n_duplicated FROM meter GROUP BY 1",
    ),
    "dq3_range_violations": (range_violations, f"WITH {b.METER} SELECT series_id, {RULES_SQL} FROM meter GROUP BY 1"),
    "dq4_timestamp_continuity": (
        timestamp_continuity,
        f"""WITH {b.RECORDS}, {CONTINUITY.format(source='records')} SELECT series_id, expected_rows, n_gaps,
        {b.r('largest_gap_minutes')}, {b.r('coverage', 6, 'n_rows / expected_rows')} FROM cont""",
    ),
    "dq5_audit": (audit, _AUDIT_SQL),
    "dq5_audit_merged": (audit_merged, _AUDIT_SQL),
    "dq6_failed_expectations": (
        failed_expectations,
        f"""WITH {b.RECORDS}, n AS (SELECT series_id, count(*) AS n, count(*) FILTER (WHERE y > 400) AS large FROM records GROUP BY 1)
        SELECT series_id || '/large' AS metric, '<=' AS op, 0.0::DOUBLE AS expected, 0.0::DOUBLE AS rtol, large::DOUBLE AS value FROM n WHERE large > 0
        UNION ALL SELECT series_id || '/unknown', '>', 0.0, 0.0, NULL FROM n""",
    ),
    "dq7_target_mismatches": (
        target_mismatches,
        f"WITH {b.NAIVE} SELECT series_id, model, count(*) AS n_rows, count(*) FILTER (WHERE hour(ts) = 3) AS n_mismatch FROM naive GROUP BY 1, 2",
    ),
    "cl1_deduplicate": (
        deduplicate,
        """WITH l AS (SELECT l_returnflag AS series_id, l_shipdate AS ts, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS ingest_ord,
            min(l_extendedprice) AS y, min(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2, 3)
        SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY series_id, ts ORDER BY ingest_ord) = 1""",
    ),
    "cl2_to_regular_grid": (
        to_regular_grid,
        f"""WITH {b.MINUTES}, firsts AS (SELECT * FROM minutes QUALIFY row_number() OVER (PARTITION BY series_id, ts ORDER BY event_id) = 1),
        points AS (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 MINUTE)) AS ts FROM minutes GROUP BY 1)
        SELECT series_id, ts, y FROM points LEFT JOIN firsts USING (series_id, ts)""",
    ),
    "cl3_run_lengths": (
        run_lengths,
        f"""WITH {b.GRID}, marked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts)
            - row_number() OVER (PARTITION BY series_id, y IS NULL ORDER BY ts) AS run FROM grid)
        SELECT series_id, ts, count(*) OVER (PARTITION BY series_id, run) AS run_length FROM marked WHERE y IS NULL""",
    ),
    "cl4_fill_gaps": (fill_gaps, f"WITH {b.HOURLY} SELECT series_id, ts, {b.r('y')} FROM hourly"),
    "cl5_resample": (
        resample,
        f"""WITH {b.METER}, h AS (SELECT series_id, date_trunc('hour', ts) AS ts, {_CAST} FROM meter),
        points AS (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM h GROUP BY 1)
        SELECT series_id, ts, {_roll(5)} FROM points LEFT JOIN h USING (series_id, ts) GROUP BY 1, 2""",
    ),
    "cl6_clean_and_resample": (
        clean_and_resample,
        f"""WITH {METER_GRID}, {b.fill_sql('grid', 'filled', METERS, 60)},
        h AS (SELECT series_id, date_trunc('hour', ts) AS ts, {', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}' for c in METERS)} FROM filled)
        SELECT series_id, ts, {_roll(3)} FROM h GROUP BY 1, 2""",
    ),
}
