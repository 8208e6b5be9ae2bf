"""Moving-average terms: recursion by blocks against a plain loop, estimates against planted coefficients."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import arma, features as ft

P = 6


def simulated(n, seed, phi=(0.4, 0.2, -0.1), theta=(0.5, -0.4, -0.2), c=0.3):
    """y whose seasonal difference follows the model."""
    e = np.random.default_rng(seed).normal(size=n)
    w, y = np.zeros(n), np.zeros(n)
    for t in range(n):
        w[t] = c + e[t]
        for k, f, g in zip((1, P, P + 1), phi, theta):
            if t >= k:
                w[t] += f * w[t - k] + g * e[t - k]
        y[t] = w[t] + (y[t - P] if t >= P else 0.0)
    return y


def residuals_by_loop(y, fit):
    n, e = len(y), {}
    value = [None if v is None else float(v) for v in y]

    def w(t):
        return None if t < P or value[t] is None or value[t - P] is None else value[t] - value[t - P]

    found = []
    for t in range(n):
        terms = [w(t), w(t - 1), w(t - P), w(t - P - 1)]
        if t < 2 * P + 1 or None in terms:
            e[t] = 0.0
            found.append(None)
            continue
        past = [e.get(t - k, 0.0) for k in (1, P, P + 1)]
        e[t] = terms[0] - fit["b_one"] - sum(fit[b] * x for b, x in zip(("b_w1", "b_wp", "b_wp1", "b_e1", "b_ep", "b_ep1"), [*terms[1:], *past]))
        found.append(e[t])
    return found


def test_residuals_of_any_block_equal_a_loop(spark, make):
    holed = list(simulated(300, 2))
    holed[50] = holed[177] = holed[178] = None
    series = {"a": list(simulated(300, 1)), "b": holed, "short": [1.0] * 5, "gone": [None] * 300}
    df = ft.chronological_split(make(series), "2024-01-11")
    fits = {s: {"b_one": 0.3, "b_w1": 0.4, "b_wp": 0.2, "b_wp1": -0.1, "b_e1": e1, "b_ep": -0.4, "b_ep1": -0.2} for s, e1 in (("a", 0.5), ("b", -0.3), ("short", 0.1))}
    fitted = spark.createDataFrame([(s, *f.values(), 10, 0.9) for s, f in fits.items()], "series_id string, b_one double, b_w1 double, b_wp double, b_wp1 double, b_e1 double, b_ep double, b_ep1 double, n_fit bigint, radius double")
    for block in (7, 40, 4096):
        rows = arma.arma_residuals(df, fitted, P, block=block).orderBy("series_id", "ts").collect()
        assert len(rows) == 905
        for s, values in series.items():
            got = [r["residual"] for r in rows if r["series_id"] == s]
            expected = residuals_by_loop(values, fits[s]) if s in fits else [None] * 300
            assert [g is None for g in got] == [x is None for x in expected]
            np.testing.assert_allclose([g for g in got if g is not None], [x for x in expected if x is not None], atol=1e-9)
            assert [r["y"] for r in rows if r["series_id"] == s] == values
    wild = fitted.withColumn("radius", F.lit(1.0))
    assert arma.arma_residuals(df, wild, P).where("residual IS NOT NULL").count() == 0


def test_estimates_find_the_planted_terms(make):
    df = ft.chronological_split(make({"a": list(simulated(6000, 3))}), "2024-08-20")
    fit = arma.fit_seasonal_arma(df, P, fit_window=None).first()
    wanted = {"b_one": 0.3, "b_w1": 0.4, "b_wp": 0.2, "b_wp1": -0.1, "b_e1": 0.5, "b_ep": -0.4, "b_ep1": -0.2}
    assert fit["radius"] < 1
    np.testing.assert_allclose([fit[k] for k in wanted], list(wanted.values()), atol=0.12)
    scored = arma.seasonal_arma_forecast(df, arma.fit_seasonal_arma(df, P, fit_window=None), P, block=500)
    error = scored.agg(F.sqrt(F.avg(F.pow(F.col("y_true") - F.col("y_pred"), 2))).alias("e"), F.count("*").alias("n")).first()
    assert error["n"] == df.where("split = 'test'").count() and error["e"] == pytest.approx(1.0, abs=0.1)


def test_series_without_a_whole_row_has_no_fit(make):
    df = ft.chronological_split(make({"a": [1.0] * 10, "b": [None] * 100}), "2025-01-01")
    assert arma.fit_seasonal_arma(df, P).count() == 0
    assert arma.seasonal_arma_forecast(df, arma.fit_seasonal_arma(df, P), P, split="train").where("y_pred IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        arma.fit_seasonal_arma(df, 2)
