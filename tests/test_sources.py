import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from wattgrid.operators import cleaning
from wattgrid.sources import meter_text, tables
from wattgrid.streaming.rollup import rollup_stream

HEADER = "Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;Sub_metering_1;Sub_metering_2;Sub_metering_3\n"


@pytest.fixture()
def meter_file(tmp_path):
    path = tmp_path / "house.txt"
    lines = []
    for i in range(1000):
        t = dt.datetime(2007, 1, 1) + dt.timedelta(minutes=i)
        power = "?" if i % 97 == 5 else f"{1 + i % 7}.5"
        last = "" if i % 97 == 5 else "17"
        lines.append(f"{t.day}/{t.month}/{t.year};{t:%H:%M:%S};{power};0.1;240.5;4.0;0;1;{last}\n")
    path.write_text(HEADER + "".join(lines))
    return path


def test_reads_the_meter_layout(spark, meter_file):
    df = meter_text.read_meter_text(spark, str(meter_file), series=F.regexp_extract("_metadata.file_name", r"^(\w+)", 1))
    assert dict(df.dtypes)["Voltage"] == "float" and dict(df.dtypes)["ts"] == "timestamp_ntz"
    got = df.agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.count_if(F.col("Global_active_power").isNull()).alias("m"),
                 F.count_if(F.col("Sub_metering_3").isNull()).alias("s"), F.min("series_id").alias("id")).first()
    assert (got["n"], got["a"], got["m"], got["s"], got["id"]) == (1000, dt.datetime(2007, 1, 1), 11, 11, "house")
    hourly = cleaning.clean_and_resample(df, "ingest_ord")
    assert hourly.count() == 17 and hourly.where("Global_active_power IS NULL").count() == 0


def test_first_in_file_wins(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text(HEADER + "".join(f"1/1/2007;0:00:00;{v};0;240;1;0;0;0\n" for v in (3, 1, 2)))
    df = meter_text.read_meter_text(spark, str(path))
    assert cleaning.deduplicate(df, "ingest_ord").first()["Global_active_power"] == 3.0


def test_bad_dates(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text(HEADER + "1/1/2007;0:00:00;1;0;240;1;0;0;0\n31/2/2007;0:00:00;1;0;240;1;0;0;0\n1/1/2007;0:01:00;oops;0;240;1;0;0;0\n")
    with pytest.raises(Exception, match="malformed|unreadable"):
        meter_text.read_meter_text(spark, str(path)).collect()
    kept = meter_text.read_meter_text(spark, str(path), on_bad="quarantine")
    assert kept.where("ts IS NULL").count() == 1 and kept.where("_bad_record IS NOT NULL").count() == 1
    assert meter_text.read_meter_text(spark, str(path), on_bad="drop").count() == 1
    with pytest.raises(ValueError):
        meter_text.with_timestamp(kept, on_bad="ignore")


def test_integrity(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 5000)
    digests = meter_text.file_digests(spark, str(tmp_path))
    good = hashlib.sha256(b"x" * 5000).hexdigest()
    schema = "name string, expected string"
    meter_text.verify_integrity(digests, spark.createDataFrame([("a.bin", good)], schema))
    with pytest.raises(ValueError, match="SHA-256 mismatch"):
        meter_text.verify_integrity(digests, spark.createDataFrame([("a.bin", "0" * 64)], schema))
    assert meter_text.integrity_mismatches(digests, spark.createDataFrame([("gone", good)], schema)).count() == 1


def test_prediction_store(spark, make, tmp_path):
    path = f"file://{tmp_path}/predictions"
    truth = make({"a": [1.0, 2.0, 3.0]}).withColumnRenamed("y", "y_true")
    tables.save_predictions(truth, truth.withColumn("y_pred", F.lit(1.0)), path, "one")
    tables.save_predictions(truth, truth.withColumn("y_pred", F.lit(2.0)), path, "two", "h=24")
    tables.save_predictions(truth, truth.withColumn("y_pred", F.lit(9.0)), path, "one", if_exists="reuse")
    stored = tables.read_predictions(spark, path)
    got = {(r["model"], r["horizon"]): r["m"] for r in stored.groupBy("model", "horizon").agg(F.max("y_pred").alias("m")).collect()}
    assert got == {("one", "h=1"): 1.0, ("two", "h=24"): 2.0}
    for name in ("first", "second"):
        truth.coalesce(1).write.parquet(f"file://{tmp_path}/stems/{name}.parquet")
    read = tables.read_prediction_files(spark, f"file://{tmp_path}/stems")
    assert {r["model"] for r in read.select("model").distinct().collect()} == {"first", "second"}


def test_stages_and_summary(spark, make, tmp_path):
    df = make({"a": [1.0, 2.0], "b": [3.0]})
    path = tables.save_hourly(df, f"file://{tmp_path}/hourly")
    assert tables.read_stage(spark, path).where("series_id = 'b'").first()["y"] == 3.0
    nested = df.groupBy("series_id").agg(F.struct(F.sum("y").alias("s")).alias("inner"))
    path = tables.save_summary(nested, f"file://{tmp_path}/summary")
    assert tables.read_summary(spark, path, nested.schema).where("inner.s = 3").count() == 2


def test_streamed_rollup_equals_batch(spark, make, tmp_path):
    df = make({"a": [float(i) for i in range(300)], "b": [1.0] * 300}, freq="7min")
    source = f"file://{tmp_path}/records"
    df.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rolled = rollup_stream(stream, {"y": ("sum", 1.0)}, lateness="100 days")
    query = rolled.writeStream.outputMode("complete").format("memory").queryName("rolled").option(
        "checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination(120)
    streamed = {(r["series_id"], r["ts"]): r["y"] for r in spark.table("rolled").collect()}
    batch = {(r["series_id"], r["ts"]): r["y"] for r in cleaning.resample(df, {"y": ("sum", 1.0)}, dtype="double").collect()}
    assert streamed == batch


def test_first_record_does_not_depend_on_how_files_share_tasks(spark, tmp_path):
    head = "Date;Time;" + ";".join(meter_text.METER_COLUMNS)
    for name, value in (("a.txt", 111.0), ("b.txt", 222.0), ("c.txt", 333.0)):
        lines = [f"1/1/2007;0:0{m}:00;{value};1;1;1;1;1;1" for m in range(3)]
        (tmp_path / name).write_text("\n".join([head, *lines, f"1/1/2007;0:00:00;{value + 1};1;1;1;1;1;1"]) + "\n")
    cost = "spark.sql.files.openCostInBytes"
    before, seen = spark.conf.get(cost), []
    try:
        for size in ("0", "1g"):
            spark.conf.set(cost, size)
            df = meter_text.read_meter_text(spark, str(tmp_path / "*.txt"))
            seen.append({(r["ts"], r["Global_active_power"]) for r in cleaning.deduplicate(df, "ingest_ord").collect()})
    finally:
        spark.conf.set(cost, before)
    assert seen[0] == seen[1] and len({v for _, v in seen[0]}) == 1


def test_horizons_of_a_model_are_stored_side_by_side(spark, tmp_path):
    path = str(tmp_path / "predictions")
    truth = spark.sql("SELECT 'a' AS series_id, timestamp_ntz'2024-01-01 00:00:00' AS ts, 1.0D AS y_true")
    for model, horizon, value in (("01", "h=1", 1.0), ("01", "h=24", 2.0), ("1", "h=1", 3.0)):
        tables.save_predictions(truth, truth.withColumn("y_pred", F.lit(value)), path, model, horizon)
    tables.save_predictions(truth, truth.withColumn("y_pred", F.lit(9.0)), path, "01", "h=24", if_exists="reuse")
    tables.save_predictions(truth, truth.withColumn("y_pred", F.lit(7.0)), path, "1", "h=24", if_exists="reuse")
    stored = {(r["model"], r["horizon"]): r["y_pred"] for r in tables.read_predictions(spark, path).collect()}
    assert stored == {("01", "h=1"): 1.0, ("01", "h=24"): 2.0, ("1", "h=1"): 3.0, ("1", "h=24"): 7.0}


def test_digest_of_a_file_above_two_gigabytes(spark, tmp_path):
    """A file of zeros that takes no disk; no record of Spark could hold it."""
    import hashlib

    size = (1 << 31) + 10
    with open(tmp_path / "zeros", "wb") as f:
        f.truncate(size)
    (tmp_path / "small").write_bytes(b"abc")
    (tmp_path / "none").write_bytes(b"")
    found = {r["path"].rsplit("/", 1)[1]: (r["length"], r["digest"]) for r in meter_text.file_digests(spark, str(tmp_path)).collect()}
    expected, piece = hashlib.sha256(), bytes(1 << 20)
    for _ in range(size >> 20):
        expected.update(piece)
    expected.update(bytes(size % (1 << 20)))
    assert found["zeros"] == (size, expected.hexdigest())
    assert found["small"] == (3, hashlib.sha256(b"abc").hexdigest()) and "none" not in found
    chunked = meter_text.file_digests(spark, str(tmp_path / "small"), whole_below=0, chunk=2).first()
    assert chunked["digest"] == found["small"][1]


def test_content_digest(spark):
    schema = "a long, b long"
    rows = [(1, None), (None, 1), (2, 3), (2, 3)]
    df = spark.createDataFrame(rows, schema)
    digest = tables.content_digest(df)
    assert tables.content_digest(spark.createDataFrame(rows[::-1], schema).repartition(3).select("b", "a")) == digest
    for changed in (rows[:3], [(1, None), (1, None), (2, 3), (2, 3)], [(1, None), (None, 1), (3, 2), (2, 3)]):
        assert tables.content_digest(spark.createDataFrame(changed, schema)) != digest
    assert tables.content_digest(df.limit(0)) != digest


def test_results_are_kept_only_while_inputs_are_unchanged(spark, make, tmp_path):
    path = f"file://{tmp_path}/predictions"
    truth = make({"a": [1.0, 2.0]}).withColumnRenamed("y", "y_true")

    def save(value, inputs=truth, **more):
        forecast = truth.select("series_id", "ts", F.lit(value).alias("y_pred"))
        tables.save_predictions(truth, forecast, path, "m", if_exists="unchanged", inputs=[inputs], **more)
        return {r["y_pred"] for r in tables.read_predictions(spark, path).collect()}

    assert save(1.0) == {1.0}
    assert save(2.0) == {1.0}  # kept
    assert save(3.0, parameters={"p": 1}) == {3.0}  # other parameters
    assert save(4.0, truth.withColumn("y_true", F.col("y_true") + 1), parameters={"p": 1}) == {4.0}  # other input
    assert save(5.0, truth.withColumn("y_true", F.col("y_true") + 1), parameters={"p": 1}) == {4.0}
    number, digest, state = tables.last_commit(spark, path, "m", "h=1")
    assert state == "finished"
    tables._commit(spark, path, (number + 1, "m", "h=1", digest, "started"))  # a write that never ended
    assert save(6.0, truth.withColumn("y_true", F.col("y_true") + 1), parameters={"p": 1}) == {6.0}
    forecast = truth.select("series_id", "ts", F.lit(7.0).alias("y_pred"))
    tables.save_predictions(truth, forecast, path, "m")  # a plain overwrite leaves no digest to reuse
    assert save(8.0, truth.withColumn("y_true", F.col("y_true") + 1), parameters={"p": 1}) == {8.0}
