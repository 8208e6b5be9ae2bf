"""Retraining alerts: batch against a plain loop, stream against batch, restart included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattgrid.operators import monitor
from wattgrid.streaming.alerts import PROVIDER, ROCKS_DB, retrain_alerts_stream

START = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
SCHEMA = "series_id string, model string, ts timestamp_ntz, y_true double, y_pred double, fitted_at timestamp_ntz"
FITS = {"a": [(0, -30), (100, 90)], "b": [(0, -200), (150, -250), (160, 155)], "c": [(0, None)]}


def rows(n=240):
    draw, made = random.Random(5), []
    for s, fits in FITS.items():
        for i in range(n):
            if draw.random() < 0.06:
                continue  # hours without a prediction
            wrong = draw.random() * (3 if (i // 40) % 2 else 0.8)
            fitted = [f for at, f in fits if i >= at][-1]
            true = None if draw.random() < 0.01 else 1.0
            made.append((s, "m", START + i * HOUR, true, 1.0 + wrong, None if fitted is None else START + fitted * HOUR))
    return made


def by_loop(made, scale, window, limit, hold, max_age, until):
    found = set()
    for s in FITS:
        ring, run, since, fitted, due = [], 0, None, None, None
        for _, _, ts, true, pred, fit in sorted((r for r in made if r[0] == s), key=lambda r: r[2]):
            if due is not None and due < ts:
                found.add((s, "age", due, fitted))
                due = None
            ring = (ring + [None if true is None else abs(true - pred)])[-window:]
            if len(ring) == window and None not in ring and sum(ring) / window / scale >= limit:
                run += 1
                since = ts if run == 1 else since
                if run == hold:
                    found.add((s, "error", ts, since))
            else:
                run = 0
            if fit is not None and (fitted is None or fit > fitted):
                fitted, due = fit, fit + max_age
        if due is not None:
            found.add((s, "age", due, fitted))
    return {f for f in found if f[2] <= until}


ARGS = {"scale": 1.0, "window": 6, "limit": 1.0, "hold": 4}


def taken(df):
    return {(r["series_id"], r["kind"], r["ts"], r["since"]) for r in df.collect()}


def test_batch_equals_loop(spark):
    made = rows()
    df = spark.createDataFrame(made, SCHEMA)
    until = START + 400 * HOUR
    got = taken(monitor.retrain_alerts(df, **ARGS, max_age_days=5, until=until.isoformat()))
    assert got == by_loop(made, 1.0, 6, 1.0, 4, dt.timedelta(days=5), until)
    assert {k for _, k, _, _ in got} == {"error", "age"} and len(got) > 6
    table = spark.createDataFrame([(s, 1.0) for s in FITS], "series_id string, scale double")
    assert taken(monitor.retrain_alerts(df, table, 6, 1.0, 4, 5, until.isoformat())) == got
    assert taken(monitor.retrain_alerts(df.limit(0), **ARGS)) == set()


def test_no_scale_no_alert(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    none = spark.createDataFrame([("a", 0.0), ("b", None)], "series_id string, scale double")
    assert {k for _, k, _, _ in taken(monitor.retrain_alerts(df, none, 6, 1.0, 4, 5))} == {"age"}


@pytest.fixture()
def rocks_db(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)
    yield spark
    spark.conf.set(PROVIDER, before)


def test_stream_with_restart_equals_batch(rocks_db, tmp_path):
    """Rows arrive out of order within the lateness, in several files, and the query stops in between."""
    spark, made = rocks_db, rows()
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    draw = random.Random(1)
    arrival = sorted(made, key=lambda r: r[2] + draw.random() * 9 * HOUR)
    third = len(arrival) // 3 + 1

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        alerts = retrain_alerts_stream(stream, **ARGS, max_age_days=5, lateness="570 minutes")
        query = alerts.writeStream.outputMode("append").format("parquet").option("path", sink).option(
            "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        assert query.awaitTermination(170)

    for part in range(3):
        piece = spark.createDataFrame(arrival[part * third:(part + 1) * third], SCHEMA)
        piece.coalesce(1).write.mode("append").parquet(source)
        if part != 1:
            run()
    watermark = max(r[2] for r in made) - dt.timedelta(minutes=570)
    got = taken(spark.read.parquet(sink))
    assert got == by_loop(made, 1.0, 6, 1.0, 4, dt.timedelta(days=5), watermark)
    assert got == taken(monitor.retrain_alerts(spark.createDataFrame(made, SCHEMA), **ARGS, max_age_days=5, until=watermark.isoformat()))
    assert spark.read.parquet(sink).groupBy("series_id", "kind", "ts").count().where(F.col("count") > 1).isEmpty()
