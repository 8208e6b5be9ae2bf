import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.functions.holidays import with_easter
from wattgrid.operators import features as ft

# Published means of the calendar features over the training rows.
CALENDAR_MEANS = {
    "hour": 11.502259350674008, "dayofweek": 2.997797607746345, "day": 15.750370229732296, "month": 6.528346307195747,
    "quarter": 2.5099677235618, "is_weekend": 0.28551357509018416, "hour_sin": -0.0001998785981641195,
    "hour_cos": 0.00011539996245523541, "dayofweek_sin": 0.0010247573284948588, "dayofweek_cos": 0.0009647278795107309,
    "month_sin": -0.004580622995978407, "month_cos": -0.0007349090211688919, "is_holiday": 0.028251376495158534,
}


@pytest.fixture(scope="module")
def hourly(make):
    rng = np.random.default_rng(42)
    h = np.arange(700)
    v = np.maximum(1 + 0.6 * np.sin(2 * np.pi * (h % 24 - 6) / 24) + rng.normal(0, 0.1, 700), 0.05)
    return make({"a": v, "b": v[::-1] * 2}, start="2007-07-01")


def frame(df, series="a"):
    return df.where(F.col("series_id") == series).orderBy("ts").toPandas().set_index("ts")


def test_calendar_means_of_the_training_period(spark):
    hours = spark.range(26335).selectExpr("timestamp_ntz'2006-12-30 17:00:00' + interval '1' hour * id AS ts")
    made = ft.add_holiday_flag(ft.add_cyclical_encodings(ft.add_calendar_features(hours)))
    got = made.agg(*[F.avg(c).alias(c) for c in CALENDAR_MEANS], F.sum("is_holiday").alias("n")).first()
    assert got["n"] == 744
    for name, want in CALENDAR_MEANS.items():
        assert got[name] == pytest.approx(want, abs=1e-12), name


@pytest.mark.parametrize("day, flag", [("2007-07-14", 1), ("2007-07-10", 0), ("2007-05-28", 0), ("2008-05-12", 1), ("2010-04-05", 1)])
def test_holidays(spark, day, flag):
    df = spark.sql(f"SELECT timestamp_ntz'{day} 12:00:00' AS ts")
    assert ft.add_holiday_flag(df).first()["is_holiday"] == flag
    calendar = spark.createDataFrame([(dt.date(2007, 7, 10),)], "date date")
    assert ft.add_holiday_flag(df, calendar=calendar).first()["is_holiday"] == int(day == "2007-07-10")


def test_easter(spark):
    years = {1997: (3, 30), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2024: (3, 31), 2038: (4, 25)}
    df = with_easter(spark.createDataFrame([(y,) for y in years], "y int"), "y", "e")
    for r in df.collect():
        assert (r["e"].month, r["e"].day) == years[r["y"]]


@pytest.mark.parametrize("rows", [None, 400])
def test_lags_and_rolling_equal_pandas(hourly, rows):
    made = ft.build_features(hourly, rows=rows)
    for series in ("a", "b"):
        got = frame(made, series)
        y = got["y"]
        for k in ft.LAGS:
            np.testing.assert_allclose(got[f"lag_{k}"], y.shift(k))
        for w in ft.ROLLING_WINDOWS:
            np.testing.assert_allclose(got[f"roll_mean_{w}"], y.shift(1).rolling(w).mean(), rtol=1e-9)
            np.testing.assert_allclose(got[f"roll_std_{w}"], y.shift(1).rolling(w).std(), rtol=1e-7)
    encoded = got[[c for c in got if c.endswith(("_sin", "_cos"))]]
    assert encoded.abs().max().max() <= 1 + 1e-12


def test_rolling_with_missing_members_and_spikes(make):
    v = np.ones(200)
    v[50], v[120] = np.nan, 1e9
    got = frame(ft.add_rolling_features(make({"a": v}), [13, 24, 7]))
    for w in (7, 13, 24):
        want = [np.std(v[i - w : i], ddof=1) if i >= w else np.nan for i in range(200)]
        np.testing.assert_allclose(got[f"roll_std_{w}"], want, atol=1e-7)
    assert got["roll_std_24"].iloc[150:].max() == 0.0  # the spike leaves no trace once it is outside


def test_warmup_and_split(hourly):
    made = ft.chronological_split(ft.build_features(hourly), "2007-07-20")
    counts = ft.count_warmup(made).where("series_id = 'a'").first()
    assert (counts["n_dropped"], counts["n_kept"]) == (336, 364)
    kept = ft.drop_warmup(made)
    assert kept.count() == 728
    splits = {(r["split"], r["ts"] < dt.datetime(2007, 7, 20)) for r in kept.select("split", "ts").collect()}
    assert splits == {("train", True), ("test", False)}


def test_model_matrix_columns(hourly):
    wide = hourly.withColumns({c: F.lit(0.0) for c in ft.LEAKING_CHANNELS})
    matrix = ft.model_matrix(ft.chronological_split(ft.build_features(wide)))
    features = ft.feature_names(matrix)
    assert len(features) == 22 and features[-1] == "is_holiday" and not set(features) & {*ft.LEAKING_CHANNELS, "year", "y", "split"}


def test_direct_matrix_uses_only_the_origin(hourly):
    made = ft.drop_warmup(ft.chronological_split(ft.build_features(hourly)))
    direct, base = frame(ft.direct_matrix(made, 24, rows=64)), frame(made)
    assert len(direct) == len(base) - 24
    np.testing.assert_allclose(direct["lag_1"], base["y"].shift(25).reindex(direct.index).fillna(base["lag_1"].shift(24).reindex(direct.index)))
    np.testing.assert_allclose(direct["roll_std_168"], base["roll_std_168"].shift(24).reindex(direct.index))
    assert (direct["hour"] == direct.index.hour).all()


def test_windows(make):
    df = make({"a": np.arange(60.0)})
    looked = ft.lookback_windows(df, 5, rows=8).orderBy("ts").collect()
    assert len(looked) == 55 and looked[0]["window"] == [0, 1, 2, 3, 4] and looked[0]["y"] == 5
    late = ft.lookback_windows(df, 5, start="2024-01-02 00:00:00").orderBy("ts").collect()
    assert len(late) == 36 and late[0]["window"] == [19, 20, 21, 22, 23]
    context = ft.context_windows(df, 3, 10, start="2024-01-01 12:00:00", rows=16).orderBy("ts").collect()
    assert context[0]["y"] == 12 and context[0]["context"] == list(range(0, 10))
    with pytest.raises(Exception, match="not enough history"):
        ft.context_windows(df, 3, 10, start="2024-01-01 11:00:00").collect()
    assert ft.context_windows(df, 3, 10, strict=False).count() == 48


def test_scaler_round_trip(make):
    df = ft.chronological_split(make({"a": [1.0, 2.0, 3.0, 10.0], "c": [5.0] * 4}), "2024-01-01 03:00:00")
    fitted = ft.scaler(df)
    scaled = ft.standardise(df, fitted)
    got = frame(scaled)["scaled"]
    np.testing.assert_allclose(got, (np.array([1, 2, 3, 10]) - 2) / np.sqrt(2 / 3))
    back = frame(ft.unstandardise(scaled, fitted, name="back"))
    np.testing.assert_allclose(back["back"], back["y"])
    assert frame(scaled, "c")["scaled"].tolist() == [0, 0, 0, 0]


def test_differences_bounds_tail(make):
    v = np.arange(50.0) ** 2
    df = make({"a": v})
    np.testing.assert_allclose(frame(ft.seasonal_difference(df, 24, rows=24))["diff"], v[24:] - v[:-24])
    tail = ft.recent_tail(df, 7)
    assert tail.count() == 7
    bounds = ft.feature_bounds(df.withColumn("split", F.lit("train")), ["y"]).first()
    assert (bounds["feature"], bounds["min"], bounds["max"]) == ("y", 0.0, 2401.0)


def test_lags_on_gaps_do_not_depend_on_bucket_size(spark, make):
    full = make({"a": [float(i) for i in range(600)]})
    gappy = full.where("NOT (y BETWEEN 100 AND 180 OR y % 7 = 3 OR y BETWEEN 300 AND 420)")
    values = [r["y"] for r in gappy.orderBy("ts").collect()]
    expected = {v: values[k - 24] if k >= 24 else None for k, v in enumerate(values)}
    for rows in (64, 100, 4096):
        found = ft.add_lag_features(gappy, [24], rows=rows, gaps="rows").collect()
        assert {r["y"]: r["lag_24"] for r in found} == expected
    with pytest.raises(Exception, match="a step is missing"):
        ft.add_lag_features(gappy, [24], rows=64).collect()


def test_windows_keep_null_members(spark, make):
    df = make({"a": [1.0, 2.0, None, 4.0, 5.0, 6.0]})
    found = {tuple(r["window"]): r["y"] for r in ft.lookback_windows(df, 3).collect()}
    assert found == {(1.0, 2.0, None): 4.0, (2.0, None, 4.0): 5.0, (None, 4.0, 5.0): 6.0}
