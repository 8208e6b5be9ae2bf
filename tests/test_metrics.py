import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import metrics as mt, validation


@pytest.fixture(scope="module")
def score(spark):
    def run(true, pred, scale=None):
        t0 = dt.datetime(2024, 1, 1)
        rows = [("a", "m", "h=1", t0 + dt.timedelta(hours=i), t, p) for i, (t, p) in enumerate(zip(true, pred))]
        df = spark.createDataFrame(rows, "series_id string, model string, horizon string, ts timestamp_ntz, y_true double, y_pred double")
        return mt.evaluate(df, scale).first()

    return run


def test_mae_rmse(score):
    got = score([1.0, 2.0, 3.0], [1.0, 2.0, 5.0], 2.0)
    assert got["mae"] == pytest.approx(2 / 3) and got["rmse"] == pytest.approx(math.sqrt(4 / 3)) and got["mase"] == pytest.approx(1 / 3)


def test_percentages_guard_zeros(score):
    assert score([0.0, 2.0], [1.0, 1.0])["mape"] == 50.0
    got = score([0.0] * 4, [0.0] * 4, 0.0)
    assert got["smape"] == 0.0 and got["mape"] is None and got["mase"] is None
    assert score([1.0, 0.0], [3.0, 0.0])["smape"] == pytest.approx(50.0)


def test_missing_rows_are_counted_not_averaged(score):
    got = score([1.0, None, 3.0], [2.0, 1.0, None])
    assert (got["n"], got["n_null"], got["mae"], got["smape"]) == (1, 2, 1.0, pytest.approx(200 / 3))


def test_scale_with_period_two(make):
    assert mt.seasonal_naive_scale(make({"a": [1, 3, 2, 6]}), 2).first()["scale"] == 2.0


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(0)
    rows = []
    for m, noise in (("good", 0.1), ("bad", 1.0)):
        for i in range(400):
            t = float(rng.normal(10, 2))
            rows.append(("a", m, "h=1", dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), t, t + float(rng.normal(0, noise))))
    return spark.createDataFrame(rows, "series_id string, model string, horizon string, ts timestamp_ntz, y_true double, y_pred double")


def test_leaderboard_order_and_rank(predictions):
    rows = mt.leaderboard(predictions, 1.5, ranked=True).collect()
    assert [r["model"] for r in rows] == ["good", "bad"] and [r["rank"] for r in rows] == [1, 2]
    assert mt.sort_leaderboard(mt.leaderboard(predictions), "rmse").first()["model"] == "good"
    with pytest.raises(ValueError):
        mt.sort_leaderboard(predictions, "r2")


def test_breakdowns_agree(predictions):
    for attribute in ("hour", "dayofweek", "month"):
        single = {(r["model"], r[attribute]): r["mae"] for r in mt.error_breakdown(predictions, attribute).collect()}
        many = mt.error_breakdowns(predictions).where(F.col("attribute") == attribute).collect()
        assert {(r["model"], r["level"]): pytest.approx(r["mae"]) for r in many} == single
    wide = mt.error_side_by_side(predictions, ["good", "bad"], "month").collect()
    assert all(r["good"] < r["bad"] for r in wide)
    worst = mt.worst_levels(mt.error_breakdown(predictions, "hour"), "hour").collect()
    assert len(worst) == 4 and worst[0]["mae"] >= worst[1]["mae"]


def test_folds_equal_the_expanding_rule(make):
    n, k = 53, 5
    df = make({"a": np.arange(float(n)), "tiny": [1.0, 2.0]})
    size = n // (k + 1)
    rows = validation.expanding_folds(df, k).collect()
    for f in range(1, k + 1):
        lo = n - (k - f + 1) * size
        assert sorted(r["y"] for r in rows if r["fold"] == f and r["role"] == "val") == [float(i) for i in range(lo, lo + size)]
        assert sorted(r["y"] for r in rows if r["fold"] == f and r["role"] == "train") == [float(i) for i in range(lo)]
    assert {r["series_id"] for r in rows} == {"a"}


def test_cv_summary(spark):
    rows = [("a", "m", 1, 1.0, 0.5, 2.0), ("a", "m", 2, 3.0, 0.7, 4.0), ("a", "z", 1, 9.0, None, None)]
    folds = spark.createDataFrame(rows, "series_id string, model string, fold int, val_mae double, train_mae double, fit_seconds double")
    first, second = mt.cv_summary(folds).collect()
    assert (first["cv_mae_mean"], first["cv_mae_std"], first["fit_seconds_mean"]) == (2.0, 1.0, 3.0)
    assert first["train_vs_cv_gap"] == pytest.approx(1.4) and second["train_vs_cv_gap"] is None
    assert mt.cv_winner(mt.cv_summary(folds)).first()["winner"] == "m"
