import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import boosting, features as ft, forecast, metrics as mt

RNG = np.random.default_rng(11)
H = np.arange(24 * 30)
SEASONAL = 10 + 5 * np.sin(2 * np.pi * H / 24) + np.convolve(RNG.normal(0, 0.6, len(H) + 2), [0.5, 0.3, 0.2], "valid")
BOUNDARY = "2024-01-25 00:00:00"


@pytest.fixture(scope="module")
def split(make):
    return ft.chronological_split(make({"a": SEASONAL, "b": SEASONAL[::-1] + 1}), BOUNDARY)


@pytest.fixture(scope="module")
def matrix(split):
    made = ft.drop_warmup(ft.build_features(split.drop("split"), lags=[1, 24, 48], windows=[24]))
    return ft.model_matrix(ft.chronological_split(made, BOUNDARY)).cache()


def test_naive(matrix):
    got = forecast.naive_forecasts(matrix, [1, 24]).where("series_id = 'a' AND model = 'naive_lag24'").orderBy("ts").toPandas()
    np.testing.assert_allclose(got["y_true"], SEASONAL[24 * 24 :])
    np.testing.assert_allclose(got["y_pred"], SEASONAL[23 * 24 : -24])


def test_seasonal_ar_equals_least_squares(split):
    window = 24 * 15
    fitted = forecast.fit_seasonal_ar(split, fit_window=window, rows=100)
    row = fitted.where("series_id = 'a'").first()
    train = SEASONAL[: 24 * 24]
    d = np.full(len(SEASONAL), np.nan)
    d[24:] = SEASONAL[24:] - SEASONAL[:-24]
    t = np.arange(len(train) - window, len(train))
    x = np.column_stack([np.ones(window), d[t - 1], d[t - 24], d[t - 25]])
    beta = np.linalg.lstsq(x, d[t], rcond=None)[0]
    np.testing.assert_allclose([row["b_one"], row["b_d1"], row["b_d2"], row["b_d3"]], beta, rtol=1e-7)
    assert row["n_fit"] == window
    scored = forecast.seasonal_ar_forecast(split, fitted).where("series_id = 'a'").orderBy("ts").toPandas()
    t = np.arange(24 * 24, len(SEASONAL))
    want = SEASONAL[t - 24] + np.column_stack([np.ones(len(t)), d[t - 1], d[t - 24], d[t - 25]]) @ beta
    np.testing.assert_allclose(scored["y_pred"], want, rtol=1e-9)


def test_align_keeps_truth(make):
    truth = make({"a": [1.0, 2.0]}).withColumnRenamed("y", "y_true")
    known = truth.where("y_true = 1").withColumn("y_pred", F.lit(5.0))
    got = forecast.align_predictions(truth, known).orderBy("ts").collect()
    assert [r["y_pred"] for r in got] == [5.0, None]


def test_nearest_moment_takes_the_later_of_two(matrix):
    predictions = forecast.naive_forecasts(matrix, [1])
    got = forecast.forecast_at(predictions, "2024-01-26 10:30:00").where("series_id = 'a'").first()
    assert got["ts"] == dt.datetime(2024, 1, 26, 11) and got["error"] == pytest.approx(got["forecast"] - got["actual"])
    context = forecast.forecast_context(matrix.where("series_id = 'a'"), "2024-01-27 00:00:00")
    assert context.count() == 55


def test_boosting_beats_the_naive_forecast(matrix, spark, tmp_path):
    from wattgrid.sources import tables

    names = ft.feature_names(matrix)
    params = boosting.BoostParams(rounds=8, depth=4, rate=0.3, max_bins=32)
    model = boosting.fit_early_stopping(matrix, names, params=params)
    test = matrix.where("split = 'test'")
    scored = boosting.score(model, test, "boosted").unionByName(forecast.naive_forecasts(matrix, [1]))
    board = {r["model"]: r["mae"] for r in mt.evaluate(scored, by=["model"]).collect()}
    assert board["boosted"] < board["naive_lag1"]
    top = boosting.feature_importances(spark, model, 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[1]["importance"]
    path = tables.save_model(model, f"file://{tmp_path}/model")
    again = boosting.score(tables.load_model(path), test, "boosted")
    assert tables.prediction_differences(boosting.score(model, test, "boosted"), again).first()["n_different"] == 0


def test_validation_and_search(matrix):
    names = ["lag_1", "lag_24", "hour", "roll_mean_24"]
    small = boosting.BoostParams(rounds=2, depth=2, max_bins=16)
    folds = boosting.cv_boosted(matrix, names, n_splits=2, params=small).collect()
    assert len(folds) == 4 and all(r["val_mae"] > 0 and r["train_mae"] > 0 and r["fit_seconds"] > 0 for r in folds)
    weak = boosting.BoostParams(rounds=1, depth=1, rate=0.01, max_bins=16)
    found = boosting.random_search(matrix, names, [weak, boosting.BoostParams(rounds=4, depth=3, rate=0.5, max_bins=16)], n_splits=2)
    assert found.params.depth == 3 and found.cv_mae == min(m for _, m in found.candidates)
    drawn = boosting.draw_params(20)
    assert drawn == boosting.draw_params(20) and all(3 <= p.depth <= 8 and 200 <= p.rounds < 1000 and 0.01 <= p.rate <= 0.15 for p in drawn)


def test_cv_of_the_seasonal_model(split):
    folds = boosting.cv_seasonal_ar(split, n_splits=3, fit_window=200).collect()
    assert sorted((r["series_id"], r["fold"]) for r in folds) == [(s, f) for s in "ab" for f in (1, 2, 3)]
    assert all(r["val_mae"] < 2 for r in folds)


def test_nearest_times_equal_brute_force(spark):
    """Requests before, between, on and after the rows, in buckets without any, of unknown series and without a time."""
    import datetime as dt
    import random

    rng, start = random.Random(4), dt.datetime(2024, 1, 1)
    rows = {s: sorted({start + dt.timedelta(minutes=30 * rng.randrange(4000)) for _ in range(60)}) for s in "ab"}
    rows["b"] = [t for t in rows["b"] if not start + dt.timedelta(days=20) < t < start + dt.timedelta(days=60)]
    asked = [(k, rng.choice("ab"), start + dt.timedelta(minutes=15 * rng.randrange(-500, 9000))) for k in range(400)]
    asked += [(500, "a", rows["a"][3]), (501, "a", rows["a"][0] + (rows["a"][1] - rows["a"][0]) / 2), (502, "c", start), (503, None, start), (504, "a", None), (505, "a", rows["a"][3])]
    table = spark.createDataFrame([(s, t) for s in rows for t in rows[s]] + [(None, start)], "series_id string, ts timestamp_ntz")
    requests = spark.createDataFrame(asked, "k int, series_id string, requested timestamp_ntz")
    expected = {}
    for _, s, t in asked:
        near = rows.get(s, [start] if s is None else [])
        expected[s, t] = min(near, key=lambda r: (abs(r - t), -r.timestamp()), default=None) if t is not None else None
    for width in (3, 50, 4096):
        found = forecast.nearest_times(requests, table, rows=width).collect()
        assert {(r["series_id"], r["requested"]): r["ts"] for r in found} == expected
        assert len(found) == len(expected)
    scored = table.where("series_id IS NOT NULL").selectExpr(
        "series_id", "inline(array(struct('m' AS model, 'h=1' AS horizon, 1.0D AS y_pred), struct('m' AS model, 'h=24' AS horizon, 3.0D AS y_pred)))", "ts", "2.0D AS y_true"
    ).where("horizon = 'h=1' OR series_id = 'a'")
    found = forecast.forecast_requests(requests, scored).collect()
    number = {"a": 2, "b": 1}
    assert len(found) == sum(number.get(s, 1) if t is not None else 1 for _, s, t in asked)
    assert {(r["k"], r["horizon"]): r["error"] for r in found if r["k"] in (500, 502, 504)} == {(500, "h=1"): -1.0, (500, "h=24"): 1.0, (502, None): None, (504, None): None}


def test_many_requests_of_one_series_take_linear_time(spark):
    """Requests of one series and bucket: the time follows their number, not its square."""
    import time

    table = spark.range(500).selectExpr("'a' AS series_id", "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, id, 0, 0) AS ts")
    requests = spark.range(200_000).selectExpr("'a' AS series_id", "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 10) AS requested")
    began = time.perf_counter()
    found = forecast.nearest_times(requests, table).selectExpr("count(*)", "max(ts) = timestamp_ntz '2024-01-21 19:00:00'").first()
    assert tuple(found) == (200_000, True)
    assert time.perf_counter() - began < 60


def test_chain_survives_one_missing_value(make):
    """Features, warm-up, day-ahead matrix and scale of a series with one missing target: rows are counted."""
    from wattgrid.operators import features as ft
    from wattgrid.operators import metrics as mt

    values = [float(i % 24 + i / 100) for i in range(400)]
    values[200] = None
    kept = ft.drop_warmup(ft.chronological_split(ft.build_features(make({"a": values}), lags=[1], windows=[2]), "2024-01-16"))
    times = [r["ts"] for r in kept.orderBy("ts").collect()]
    lags = [r["lag_1"] for r in kept.orderBy("ts").collect()]
    moved = ft.direct_matrix(kept, 24).orderBy("ts").collect()
    assert len(times) == 400 - 2 - 2 and len(moved) == len(times) - 24 - 1  # the row of the hole has no target
    at = {t: i for i, t in enumerate(times)}
    assert [r["lag_1"] for r in moved] == [lags[at[r["ts"]] - 24] for r in moved]
    train = [r["y"] for r in kept.where("split = 'train'").orderBy("ts").collect()]
    expected = [abs(b - a) for a, b in zip(train, train[24:]) if a is not None and b is not None]
    assert mt.seasonal_naive_scale(kept.where("split = 'train'")).first()["scale"] == pytest.approx(sum(expected) / len(expected))
