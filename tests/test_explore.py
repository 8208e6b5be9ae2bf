import datetime as dt
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import explore as ex, metrics as mt, monitor as mn
from wattgrid.plans import ranks

RNG = np.random.default_rng(2)
V = np.round(RNG.gamma(2, 3, 24 * 50), 2)


@pytest.fixture(scope="module")
def series(make):
    return make({"a": V, "flat": np.ones(48)})


def test_slices(series):
    assert ex.zoom(series, 7).where("series_id = 'a'").count() == 169
    assert ex.zoom(series, 1).where("series_id = 'a'").count() == 25
    assert ex.slice_between(series, "2024-01-01 05:00:00", "2024-01-01 07:00:00").count() == 6


@pytest.mark.parametrize("approximate", [False, True])
def test_box_statistics(series, approximate):
    got = ex.box_statistics(series, ("hour",), approximate=approximate).where("series_id = 'a' AND level = 3").first()
    v = V[3::24]
    q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75], method="linear" if not approximate else "inverted_cdf")
    assert (got["q1"], got["median"], got["q3"]) == pytest.approx((q1, q2, q3))
    fence = 1.5 * (q3 - q1)
    inside = v[(v >= q1 - fence) & (v <= q3 + fence)]
    assert (got["whisker_low"], got["whisker_high"], got["n_outliers"], got["n"]) == (inside.min(), inside.max(), len(v) - len(inside), 50)


def test_box_statistics_count_few_values(spark, monkeypatch):
    """Different values throughout: only those near the quartiles are counted one by one."""
    n, counted = 100_000, []

    def watched(cumulated, *rest, whole=ranks.quantile_table):
        counted.append(cumulated.count())
        return whole(cumulated, *rest)

    monkeypatch.setattr(ranks, "quantile_table", watched)
    hour = F.lit(dt.datetime(2024, 1, 1, 3)).cast("timestamp_ntz")
    value = F.when(F.col("id") == 0, -0.0).otherwise(F.col("id") * 7919 % n)
    rows = spark.range(0, n, 1, 4).select(F.lit("a").alias("series_id"), hour.alias("ts"), value.alias("y"))
    found = ex.box_statistics(rows, ("hour",))
    got = found.first()
    assert (got["n"], got["q1"], got["median"], got["q3"], got["n_outliers"]) == (n, (n - 1) / 4, (n - 1) / 2, 3 * (n - 1) / 4, 0)
    assert str((got["whisker_low"], got["whisker_high"])) == str((0.0, n - 1.0))
    assert len(counted) == 1 and counted[0] < n // 10
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate [") == 1


def test_histogram(series):
    got = ex.histogram(series, 80).where("series_id = 'a'").orderBy("bin").toPandas()
    counts, edges = np.histogram(V, 80)
    assert abs(got["n"] - counts).sum() <= 2 and got["n"].sum() == len(V) and len(got) == 80
    np.testing.assert_allclose(got["bin_low"], edges[:-1])
    flat = ex.histogram(series, 10).where("series_id = 'flat' AND n > 0").first()
    assert flat["n"] == 48 and flat["bin_low"] <= 1 <= flat["bin_high"]


def test_profiles(spark, series):
    heat = ex.load_heatmap(series).where("series_id = 'a' AND hour = 5").first()
    mondays = V[5::24][::7]
    assert heat["dow_0"] == pytest.approx(mondays.mean())
    rows = [("a", dt.datetime(2024, 1, 5), 1.0), ("a", dt.datetime(2024, 1, 9), 3.0), ("a", dt.datetime(2024, 4, 1), 5.0)]
    gaps = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    assert [r["mean"] for r in ex.monthly_profile(gaps).orderBy("month_start").collect()] == [2.0, None, None, 5.0]
    found = ex.dataset_summary(gaps).first()
    assert (found["n_rows"], str(found["first_date"]), str(found["last_date"])) == (3, "2024-01-05", "2024-04-01")
    described = ex.describe(gaps, ["y"]).first()
    assert (described["count"], described["mean"], described["p25"], described["max"]) == (3, 3.0, 2.0, 5.0)


@pytest.mark.parametrize("rows", [None, 32])
def test_decomposition_recovers_the_season(make, rows):
    t = np.arange(24 * 20)
    season = np.sin(2 * np.pi * t / 24)
    got = ex.decompose(make({"a": 0.01 * t + season}), 24, rows=rows).orderBy("ts").toPandas()
    inner = slice(12, -12)
    np.testing.assert_allclose(got["trend"][inner], 0.01 * t[inner], atol=1e-9)
    np.testing.assert_allclose(got["seasonal"], season, atol=1e-9)
    np.testing.assert_allclose(got["remainder"][inner], 0, atol=1e-9)
    assert got["trend"].isna().sum() == 24


def test_rolling_statistics(series):
    import pandas as pd

    got = ex.rolling_statistics(series, rows=200).where("series_id = 'a'").orderBy("ts").toPandas()
    y = pd.Series(V)
    np.testing.assert_allclose(got["mean_daily"], y.rolling(24).mean())
    np.testing.assert_allclose(got["band_high"], y.rolling(168).mean() + y.rolling(168).std())


def test_qq_points_with_ties(spark):
    v = [1.0, 2.0, 2.0, 2.0, 5.0, -1.0]
    df = spark.createDataFrame([("a", "m", x) for x in v], "series_id string, model string, residual double")
    got = ex.qq_points(df).orderBy("i").toPandas()
    assert got["ordered"].tolist() == sorted(v)
    n = len(v)
    top = 0.5 ** (1 / n)
    positions = [1 - top, *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], top]
    np.testing.assert_allclose(got["theoretical"], [NormalDist().inv_cdf(p) for p in positions], atol=1e-9)
    slope = np.polyfit(got["theoretical"], got["ordered"], 1)
    line = ex.qq_line(ex.qq_points(df)).first()
    assert (line["slope"], line["intercept"]) == pytest.approx(tuple(slope))


def test_weeks_and_overlay(spark, series):
    weeks = [r["week_start"] for r in ex.week_grid(series).where("series_id = 'a'").orderBy("week_start").collect()]
    assert weeks[:2] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)] and len(weeks) == 8
    # 4.5 days after a week start is nearer to the next one; an exact tie goes to the earlier week
    assert ex.nearest_week(series.where("series_id = 'a'"), "2024-01-11 12:00:00").first()["week_start"] == dt.datetime(2024, 1, 8)
    predictions = series.select(
        "series_id", F.explode(F.array(F.lit("m"), F.lit("z"))).alias("model"), "ts", F.col("y").alias("y_true"), (F.col("y") + 1).alias("y_pred")
    )
    overlay = ex.actual_vs_predicted(predictions, ["m", "z"], "2024-01-08")
    assert overlay.count() == 169 and overlay.where("m = y_true + 1 AND z = m").count() == 169


def test_drift_and_retraining(make):
    v = np.concatenate([RNG.normal(0, 1, 400), RNG.normal(3, 1, 200)])
    df = make({"moved": v, "same": RNG.normal(0, 1, 600)})
    boundary = "2024-01-17 16:00:00"
    psi = {r["series_id"]: r for r in mn.population_stability(df, "y", boundary).collect()}
    assert psi["moved"]["drift"] and not psi["same"]["drift"]
    ks = {r["series_id"]: r["ks"] for r in mn.kolmogorov_smirnov(df, "y", boundary).collect()}
    a, b = np.sort(v[:400]), np.sort(v[400:])
    want = max(abs(np.searchsorted(a, x, "right") / 400 - np.searchsorted(b, x, "right") / 200) for x in v)
    assert ks["moved"] == pytest.approx(want) and ks["same"] < 0.2
    errors = df.select("series_id").distinct().withColumn("mase", F.lit(0.5))
    decided = {r["series_id"]: r for r in mn.retrain_decision(mn.population_stability(df, "y", boundary), errors, "2024-02-01", "2024-01-20").collect()}
    assert decided["moved"]["reason"] == "drift" and not decided["same"]["retrain"]
    aged = mn.retrain_decision(mn.population_stability(df, "y", boundary), errors, "2024-03-01", "2024-01-20")
    assert aged.where("reason = 'age'").count() == 1


def test_rolling_errors(make):
    df = make({"a": np.arange(50.0)}).select(
        "series_id", F.lit("m").alias("model"), "ts", F.col("y").alias("y_true"), (F.col("y") * 2).alias("y_pred")
    )
    got = mt.rolling_errors(df, 5, 2.0).orderBy("ts").collect()
    assert got[3]["rolling_mae"] is None and got[9]["rolling_mae"] == pytest.approx(7.0) and got[9]["rolling_mase"] == pytest.approx(3.5)


def test_selected_order_statistics(spark):
    values = [float(i * i % 97) for i in range(1000)]
    df = spark.createDataFrame([("a", "m", v) for v in values] + [("b", "m", 1.0), ("b", "m", None), ("c", "m", 5.0), ("c", "m", 4.0)], "series_id string, model string, residual double")
    whole = {(r["series_id"], r["i"]): (r["ordered"], r["theoretical"]) for r in ex.qq_points(df).collect()}
    for points in (2, 7, 500, 999, 1000, 2000):
        got = ex.qq_points(df, points=points).where("series_id = 'a'").collect()
        n = min(points, 1000)
        assert [r["i"] for r in sorted(got, key=lambda r: r["i"])] == [1 + k * 999 // (n - 1) for k in range(n)]
        assert all(whole["a", r["i"]] == (r["ordered"], r["theoretical"]) for r in got)
    assert ex.qq_points(df, points=7).where("series_id <> 'a'").count() == 3
