import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import cleaning

NA = float("nan")


def values(df, column="y"):
    return [r[column] for r in df.orderBy("series_id", "ts").collect()]


def reference_fill(v: list, limit: int) -> list:
    """Plain restatement of the fill rule on one list."""
    out = list(v)
    n = len(v)
    for i, x in enumerate(v):
        if not np.isnan(x):
            continue
        p = max((j for j in range(i) if not np.isnan(v[j])), default=None)
        q = min((j for j in range(i + 1, n) if not np.isnan(v[j])), default=None)
        if p is None:
            out[i] = v[q] if q is not None else NA
        elif q is None or q - p - 1 <= limit:
            out[i] = v[p]
        else:
            out[i] = v[p] + (v[q] - v[p]) * (i - p) / (q - p)
    return out


@pytest.mark.parametrize(
    "given, limit, wanted",
    [([1, 2, NA, NA, 5], 60, [1, 2, 2, 2, 5]), ([1, NA, NA, NA, 5], 2, [1, 2, 3, 4, 5]), ([NA, NA, 3, NA, NA], 1, [3, 3, 3, 3, 3])],
)
def test_fill_by_run_length(make, given, limit, wanted):
    df = make({"a": given}, freq="min")
    assert values(cleaning.fill_gaps(df, ["y"], limit)) == wanted


@pytest.mark.parametrize("rows", [4, 16, 4096])
def test_fill_random_gaps_across_buckets(make, rows):
    rng = np.random.default_rng(7)
    series = {}
    for k in range(6):
        v = rng.normal(size=90)
        v[rng.random(90) < 0.5] = NA
        v[20:45] = NA
        series[f"s{k}"] = v
    series["empty"] = np.full(10, NA)
    got = values(cleaning.fill_gaps(make(series, freq="min"), ["y"], 3, rows=rows))
    want = [x for k in sorted(series) for x in reference_fill(list(series[k]), 3)]
    for g, w in zip(got, want, strict=True):
        assert (g is None and np.isnan(w)) or g == pytest.approx(w, abs=1e-12)


def test_missing_runs(make):
    v = [NA, 1, NA, NA, 2, NA, NA, NA]
    found = cleaning.missing_runs(make({"a": v}, freq="min"), "y", rows=3)
    assert values(found, "run_length") == [1, 2, 2, 3, 3, 3]


def test_resample_constant_hours(spark):
    start = dt.datetime(2007, 1, 1)
    rows = [("m", start + dt.timedelta(minutes=i), 6.0, 0.5, 240.0, 25.0, 1.0, 2.0, 3.0) for i in range(120)]
    columns = list(cleaning.METER_ROLLUP)
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, " + ", ".join(f"{c} float" for c in columns))
    out = cleaning.resample(df).orderBy("ts").collect()
    assert len(out) == 2
    assert out[0]["Global_active_power"] == pytest.approx(6.0)
    assert out[0]["Voltage"] == 240.0 and out[1]["Sub_metering_1"] == 60.0
    assert dict(cleaning.resample(df).dtypes)["Voltage"] == "float"


def test_empty_hours_have_zero_sum_and_null_mean(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 5), 1.0, 2.0), ("a", dt.datetime(2024, 1, 1, 3, 5), 4.0, 6.0)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, s double, m double")
    out = cleaning.resample(df, {"s": ("sum", 1.0), "m": ("mean", 1.0)}, dtype="double").orderBy("ts").collect()
    assert [(r["s"], r["m"]) for r in out] == [(1, 2), (0, None), (0, None), (4, 6)]


def test_grid_keeps_first_and_drops_off_grid(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 30)
    minute = dt.timedelta(minutes=1)
    rows = [("a", t, 1.0, 2), ("a", t, 9.0, 1), ("a", t + minute / 2, 5.0, 3), ("a", t + 3 * minute, None, 4), ("a", t + 3 * minute, 7.0, 5)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double, ord long")
    assert values(cleaning.to_regular_grid(df, ["y"], "ord")) == [9.0, None, None, None]
    assert values(cleaning.deduplicate(df, "ord")) == [9.0, 5.0, None]


def test_pipeline_equals_its_steps(make, spark):
    rng = np.random.default_rng(3)
    v = rng.gamma(2, 1, 3000)
    v[rng.random(3000) < 0.2] = NA
    v[700:900] = NA
    df = make({"a": v, "b": v[::-1]}, freq="min").withColumn("ord", F.lit(0)).where("y is not null")
    spec = {"y": ("sum", 1 / 60)}
    whole = cleaning.clean_and_resample(df, "ord", spec, dtype="double", rows=120)
    steps = cleaning.resample(cleaning.fill_gaps(cleaning.to_regular_grid(df, ["y"], "ord"), ["y"]), spec, dtype="double")
    np.testing.assert_allclose(values(whole), values(steps), rtol=1e-12)
    frame = pd.Series(v, index=pd.date_range("2024-01-01", periods=3000, freq="min"))
    filled = pd.Series(reference_fill(list(frame), 60), index=frame.index)
    hourly = filled.loc[frame.first_valid_index() : frame.last_valid_index()].resample("h").sum() / 60
    got = [r["y"] for r in whole.where("series_id = 'a'").orderBy("ts").collect()]
    np.testing.assert_allclose(got, hourly.to_numpy(), rtol=1e-9)


def test_fill_shuffles_once_for_both_branches(make):
    df = make({"a": [1.0, NA, 3.0]}, freq="min")
    out = cleaning.fill_gaps(df, ["y"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "BroadcastExchange" in plan
