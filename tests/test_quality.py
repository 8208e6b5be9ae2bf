import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattgrid.operators import quality

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("a", at(0), 1.0, 240.0), ("a", at(1), None, 219.0), ("a", at(1), 2.0, 251.0), ("a", at(5), -1.0, None),
        ("a", at(20000), 3.0, 250.0), ("b", at(0), 0.0, 220.0),
    ]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, p double, Voltage double")


def one(df, series="a"):
    return df.where(F.col("series_id") == series).first().asDict()


def test_continuity_with_gap_longer_than_a_bucket(raw):
    found = one(quality.timestamp_continuity(raw))
    assert found["expected_rows"] == 20001 and found["n_gaps"] == 2
    assert found["largest_gap_minutes"] == 19995.0 and found["coverage"] == pytest.approx(5 / 20001)
    alone = one(quality.timestamp_continuity(raw), "b")
    assert (alone["n_gaps"], alone["largest_gap_minutes"], alone["coverage"]) == (0, 0.0, 1.0)


def test_gap_is_measured_to_fractions(spark):
    rows = [("a", T0), ("a", T0 + dt.timedelta(seconds=60)), ("a", T0 + dt.timedelta(seconds=120.5))]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz")
    assert one(quality.timestamp_continuity(df))["n_gaps"] == 1


def test_audit_equals_its_parts(raw):
    rules = {"voltage": (F.col("Voltage") < 220) | (F.col("Voltage") > 250), "negative": F.col("p") < 0}
    found = one(quality.audit(raw, ["p", "Voltage"], rules))
    assert found["n_rows"] == 5 and found["n_duplicated_timestamps"] == 1
    assert found["missing_p"] == 1 and found["missing_Voltage"] == 1 and found["missing_rate"] == pytest.approx(0.2)
    assert found["voltage"] == 2 and found["negative"] == 1
    assert found["expected_rows"] == 20001 and found["n_gaps"] == 2
    assert found["summary"].startswith("5 of 20,001 expected readings") and "longest lasts 19995 minutes" in found["summary"]
    assert one(quality.duplicate_timestamps(raw))["n_duplicated"] == 1
    assert one(quality.range_violations(raw, rules))["voltage"] == 2


def test_missing_report_is_sorted(raw):
    rows = quality.missing_report(raw, ["p", "Voltage"]).collect()
    assert [(r["column"], r["n_missing"]) for r in rows] == [("Voltage", 1), ("p", 1)]


def test_expectations(spark):
    metrics = spark.createDataFrame([("h", 8800.0), ("p", 0.2)], "metric string, value double")
    wanted = spark.createDataFrame(
        [("h", "close", 8842.5, 0.05), ("p", "<=", 0.05, 0.0), ("gone", ">=", 1.0, 0.0)], "metric string, op string, expected double, rtol double"
    )
    failed = {r["metric"] for r in quality.failed_expectations(metrics, wanted).collect()}
    assert failed == {"p", "gone"}
    with pytest.raises(ValueError, match="expectations failed"):
        quality.require_expectations(metrics, wanted)
    quality.require_expectations(metrics, wanted.where("metric = 'h'"))


def test_target_mismatch(spark, make):
    series = make({"a": [1.0, 2.0]})
    predictions = series.select("series_id", F.lit("m").alias("model"), "ts", (F.col("y") + F.when(F.col("y") > 1, 1).otherwise(0)).alias("y_true"))
    assert quality.target_mismatches(predictions, series).first()["n_mismatch"] == 1


def test_merged_states_equal_the_audit(spark):
    """Parts that overlap in time, repeat times across parts and leave holes; NULL times in two parts."""
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(minutes=m), None if m % 7 == 0 else float(m % 300)) for m in (*range(500), *range(40_000, 90_000, 3))]
    rows += [("a", start + dt.timedelta(minutes=m), 1.0) for m in (3, 3, 40_000)] + [("b", start, 2.0), ("a", None, 1.0), ("a", None, None)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    rules = {"large": F.col("y") > 290}
    parts = [df.where(F.pmod(F.xxhash64("ts", "y"), F.lit(3)) == i) for i in range(3)]
    states = [quality.audit_state(p, ["y"], rules) for p in [*parts, df.limit(0)]]
    first = quality.merge_audit_states(states[0].unionByName(states[2]))
    merged = quality.audit_of_states(states[1].unionByName(first).unionByName(states[3]), ["y"], ["large"])
    whole = quality.audit(df, ["y"], rules)
    assert merged.columns == whole.columns
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert merged.where("n_duplicated_timestamps = 4 AND largest_gap_minutes > 39000").count() == 1
    off = spark.createDataFrame([("a", start + dt.timedelta(seconds=1), 1.0)], df.schema)
    with pytest.raises(Exception, match="not on the grid"):
        quality.audit_state(off, ["y"]).collect()
    assert quality.audit_state(off, ["y"], resolution=1).count() == 1
