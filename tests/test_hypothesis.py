import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.functions.distributions import adf_pvalue, cross_sums, gamma_upper, normal_quantile
from wattgrid.operators import hypothesis as hy

RNG = np.random.default_rng(5)
NOISE = RNG.normal(size=900)
WALK = np.cumsum(RNG.normal(size=900))
H = np.arange(900)
DAILY = 5 + 2 * np.sin(2 * np.pi * H / 24) + RNG.normal(0, 0.5, 900)


@pytest.fixture(scope="module")
def series(make):
    return make({"noise": NOISE, "walk": WALK, "daily": DAILY})


def brute_acf(v, lags):
    e = v - v.mean()
    return np.array([(e[k:] * e[: len(e) - k]).sum() for k in range(lags + 1)]) / (e @ e)


@pytest.mark.parametrize("lags, rows", [(48, 64), (168, None), (300, 320)])
def test_acf(series, lags, rows):
    got = hy.acf(series, lags, rows=rows).toPandas()
    for name, v in (("noise", NOISE), ("walk", WALK)):
        part = got[got.series_id == name].sort_values("lag")
        r = brute_acf(v, lags)
        np.testing.assert_allclose(part["acf"], r, atol=1e-10)
        assert part["band"].iloc[3] == pytest.approx(1.959963984540054 * math.sqrt((1 + 2 * (r[1] ** 2 + r[2] ** 2)) / 900))


def test_acf_closes_up_missing_values(make):
    v = NOISE[:200].copy()
    v[::9] = np.nan
    got = hy.acf(make({"a": v}), 5).orderBy("lag").toPandas()
    np.testing.assert_allclose(got["acf"], brute_acf(v[~np.isnan(v)], 5), atol=1e-12)


def test_pacf_solves_yule_walker(series):
    got = hy.pacf(series.where("series_id = 'daily'"), 30).orderBy("lag").toPandas()["pacf"].to_numpy()
    r = brute_acf(DAILY, 30)
    for k in (1, 2, 5, 24, 30):
        toeplitz = r[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        assert got[k] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1], abs=1e-9)


def test_ljung_box(series):
    got = {(r["series_id"], r["lag"]): r for r in hy.ljung_box(series, [24, 100]).collect()}
    r = brute_acf(DAILY, 100)
    q = 900 * 902 * sum(r[k] ** 2 / (900 - k) for k in range(1, 25))
    assert got["daily", 24]["statistic"] == pytest.approx(q) and got["daily", 24]["pvalue"] < 1e-12
    assert got["noise", 100]["pvalue"] > 0.01


def brute_kruskal(v, g):
    order = np.argsort(v, kind="stable")
    ranks = np.empty(len(v))
    ranks[order] = np.arange(1, len(v) + 1)
    for x in np.unique(v):
        ranks[v == x] = ranks[v == x].mean()
    n = len(v)
    h = 12 / (n * (n + 1)) * sum(ranks[g == k].sum() ** 2 / (g == k).sum() for k in np.unique(g)) - 3 * (n + 1)
    ties = sum(c**3 - c for c in np.unique(v, return_counts=True)[1])
    return h / (1 - ties / (n**3 - n))


def test_kruskal_with_ties(make):
    v = np.round(DAILY, 1)
    found = hy.kruskal_by(make({"d": v, "n": np.round(NOISE, 1)}), "hour").collect()
    got = {r["series_id"]: r for r in found}
    assert got["d"]["statistic"] == pytest.approx(brute_kruskal(v, H % 24)) and got["d"]["significant"]
    assert not got["n"]["significant"]


def brute_adf(y):
    n = len(y)
    order = hy.adf_max_lag(n)
    dy = np.diff(y)

    def design(p, first):
        t = np.arange(first, n)
        return np.column_stack([np.ones(len(t)), y[t - 1], *[dy[t - 1 - k] for k in range(1, p + 1)]]), dy[t - 1]

    scores = []
    for p in range(order + 1):
        x, z = design(p, order + 1)
        beta = np.linalg.lstsq(x, z, rcond=None)[0]
        scores.append((len(z) * math.log(((z - x @ beta) ** 2).mean()) + 2 * (p + 2), p))
    p = min(scores)[1]
    x, z = design(p, p + 1)
    beta = np.linalg.lstsq(x, z, rcond=None)[0]
    s2 = ((z - x @ beta) ** 2).sum() / (len(z) - x.shape[1])
    return beta[1] / math.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1]), p


def test_adf(series):
    got = {r["series_id"]: r for r in hy.adf(series, rows=128).collect()}
    for name, v in (("noise", NOISE), ("walk", WALK), ("daily", DAILY)):
        statistic, order = brute_adf(v)
        assert got[name]["adf_lags"] == order
        assert got[name]["adf_stat"] == pytest.approx(statistic, rel=1e-7)
    assert got["noise"]["adf_pvalue"] < 1e-6 and got["walk"]["adf_pvalue"] > 0.05


def brute_kpss(v):
    n, e = len(v), v - v.mean()
    pilot = int(n ** (2 / 9))
    s0, s1 = (e**2).sum() / n, 0.0
    for i in range(1, pilot + 1):
        c = e[i:] @ e[: n - i] / (n / 2)
        s0, s1 = s0 + c, s1 + i * c
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    longrun = (e**2).sum() + 2 * sum(e[i:] @ e[: n - i] * (1 - i / (lags + 1)) for i in range(1, lags + 1))
    return (np.cumsum(e) ** 2).sum() / n**2 / (longrun / n), lags


def test_kpss(series):
    got = {r["series_id"]: r for r in hy.kpss(series, rows=256).collect()}
    for name, v in (("noise", NOISE), ("walk", WALK), ("daily", DAILY)):
        statistic, lags = brute_kpss(v)
        assert got[name]["kpss_lags"] == lags
        assert got[name]["kpss_stat"] == pytest.approx(statistic, rel=1e-8)
    assert got["noise"]["kpss_pvalue"] == 0.1 and got["walk"]["kpss_pvalue"] < 0.05


def test_verdicts(spark, series):
    rows = [(0.01, 0.10), (0.2, 0.01), (0.01, 0.01), (0.2, 0.1)]
    got = [r["verdict"] for r in hy.verdict(spark.createDataFrame(rows, "adf_pvalue double, kpss_pvalue double")).collect()]
    assert got == ["stationary", "non-stationary", "inconclusive", "inconclusive"]
    pair = {(r["series_id"], r["label"]): r["verdict"] for r in hy.stationarity_raw_and_differenced(series).collect()}
    assert pair["noise", "raw"] == "stationary" and pair["walk", "raw"] == "non-stationary"
    single = {r["series_id"]: r["verdict"] for r in hy.stationarity(series).collect()}
    assert single["walk"] == pair["walk", "raw"]


def test_summary_document(series):
    document = hy.summarize(series, ljung_lags=[24, 48])
    row = document.where("series_id = 'daily'").first()
    assert row["n_obs"] == 900 and row["kruskal"]["hour"]["significant"]
    assert [x["lag"] for x in row["ljung_box"]["results"]] == [24, 48]
    assert row["stationarity"]["seasonal_diff"]["label"] == "seasonal_diff_24"
    assert hy.headline_metrics(document).where("metric = 'ljung_box_24'").count() == 3


def test_tails(spark):
    assert adf_pvalue(-14.369003115164547) == pytest.approx(9.56439329930824e-27, rel=1e-4)
    assert adf_pvalue(-41.0) == 0.0 and adf_pvalue(3.0) == 1.0 and adf_pvalue(-2.8615) == pytest.approx(0.05, abs=2e-3)
    assert gamma_upper(0.5, 3.841458820694124 / 2) == pytest.approx(0.05) and gamma_upper(5, 18.307038053275146 / 2) == pytest.approx(0.05)
    assert gamma_upper(360, 5000.0) < 1e-100
    probabilities = [1e-12, 1e-5, 0.02, 0.074, 0.3, 0.5, 0.77, 0.99, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in probabilities], "p double").select("p", normal_quantile(F.col("p")).alias("z"))
    for r in df.collect():
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-9)


def test_cross_sums_both_ways():
    own, extended = NOISE[300:500], NOISE[:500]
    direct = [sum(own * extended[300 - k : 500 - k]) for k in range(301)]
    np.testing.assert_allclose(cross_sums(own, extended, 300), direct, atol=1e-10)
    np.testing.assert_allclose(cross_sums(own, NOISE[290:500], 10), direct[:11], atol=1e-12)


@pytest.fixture(scope="module")
def odd(make):
    """A good series beside a constant, a one-row, a short and an all-NULL one."""
    return make({"good": list(NOISE[:400]), "dead": [5.0] * 400, "one": [1.0], "short": [1.0, 2.0, 4.0], "void": [None] * 50})


def test_odd_series_keep_their_rows(odd):
    def by_series(df):
        return {r["series_id"]: r for r in df.collect()}

    kruskal = by_series(hy.kruskal_by(odd, "hour"))
    assert kruskal["dead"]["statistic"] is None and kruskal["one"]["statistic"] is None and kruskal["good"]["pvalue"] is not None
    alone = by_series(hy.kruskal_by(odd.where("series_id = 'good'"), "hour"))
    assert kruskal["good"]["statistic"] == pytest.approx(alone["good"]["statistic"])
    assert {r["acf"] for r in hy.acf(odd, 24).where("series_id = 'dead'").collect()} == {None}
    assert {r["pacf"] for r in hy.pacf(odd, 24).where("series_id = 'dead'").collect()} == {None}
    assert {r["pvalue"] for r in hy.ljung_box(odd, [24]).where("series_id = 'dead'").collect()} == {None}
    tests = by_series(hy.stationarity(odd))
    assert set(tests) == {"good", "dead", "one", "short", "void"}
    assert tests["good"]["verdict"] == "stationary" and tests["dead"]["verdict"] is None and tests["void"]["kpss_stat"] is None
    assert tests["short"]["adf_stat"] is None and tests["short"]["kpss_stat"] is not None
    assert set(by_series(hy.summarize(odd, ljung_lags=[24]))) == set(tests)


def test_dead_meter_changes_no_other_bandwidth(make, monkeypatch):
    """A constant series has no KPSS result and does not widen the pass over the others."""
    reaches = []
    products = hy.bucket_products
    monkeypatch.setattr(hy, "bucket_products", lambda df, reach, *rest: reaches.append(reach) or products(df, reach, *rest))
    found = {r["series_id"]: r for r in hy.kpss(make({"noise": NOISE, "dead": np.full(900, 2.0)})).collect()}
    alone = hy.kpss(make({"noise": NOISE})).first()
    assert found["noise"]["kpss_lags"] == alone["kpss_lags"] and found["noise"]["kpss_stat"] == pytest.approx(alone["kpss_stat"])
    assert found["dead"]["kpss_stat"] is None and found["dead"]["kpss_lags"] is None
    assert reaches[:2] == reaches[2:]
