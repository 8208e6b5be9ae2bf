"""Statistical tests, exploratory views and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattgrid.functions import distributions as ds
from wattgrid.functions.timeaxis import DAY
from wattgrid.operators import explore as ex, hypothesis as hy, metrics as mt, monitor as mn, boosting, features as ft
from wattgrid.session import scratch_path, staged
from wattgrid.sources import tables
from wattgrid.streaming import alerts
from wattgrid.workload import base as b
from wattgrid.workload.modelling import SMALL

SALES_KEYS = ["series_id", "model"]


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly series, stored once because the tests below read it several times."""
    return staged(b.hourly(spark, sf_dir))


def _sales_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.residuals(b.sales_predictions(spark, sf_dir))


# --- tests ------------------------------------------------------------------------------------


def kruskal_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hy.kruskal_by(_hourly(spark, sf_dir), "hour")
    return b.rounded(found.select("series_id", "factor", "statistic", "significant"), 4)


def kruskal_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale prices across calendar months: many rows, few series."""
    sales = b.sales_predictions(spark, sf_dir)
    return b.rounded(hy.kruskal_by(sales, "month", "y_true").select("series_id", "factor", "statistic"), 4)


def acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(hy.acf(_hourly(spark, sf_dir), 168).select("series_id", F.col("lag").cast("bigint").alias("lag"), "acf", "band"))


def pacf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(hy.pacf(_hourly(spark, sf_dir), 168))


def ljung_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hy.ljung_box(_hourly(spark, sf_dir), [24, 48, 168])
    return b.rounded(found.select("series_id", F.col("lag").cast("bigint").alias("lag"), "statistic"), 4)


def adf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(hy.adf(_hourly(spark, sf_dir)))


def kpss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(hy.kpss(_hourly(spark, sf_dir)))


def adf_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistic and chosen lag order, without the table-based p-value."""
    return b.rounded(hy.adf(_hourly(spark, sf_dir)).select("series_id", "adf_stat", "adf_lags"))


def kpss_dead_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant series beside the others: it has no result and changes no other one's."""
    live = _hourly(spark, sf_dir).select("series_id", "ts", "y")
    dead = live.select(F.concat(F.lit("dead "), "series_id").alias("series_id"), "ts", F.lit(3.0).alias("y"))
    return b.rounded(hy.kpss(live.unionByName(dead)))


def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joint reading over p-values spread across the event values."""
    pairs = b.table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") / 5000).alias("adf_pvalue"), (F.col("event_id") % 100 / 1000).alias("kpss_pvalue")
    )
    return b.rounded(hy.verdict(pairs), 8)


def stationarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(hy.stationarity_raw_and_differenced(_hourly(spark, sf_dir)))


def summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested document, written as JSON and read back."""
    document = hy.summarize(_hourly(spark, sf_dir), ljung_lags=[24, 168])
    path = tables.save_summary(document, scratch_path(spark, "statistics"))
    return hy.headline_metrics(tables.read_summary(spark, path, document.schema))


# --- views ------------------------------------------------------------------------------------


def slice_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.records(spark, sf_dir)
    return ex.slice_between(rows, "2024-01-10 00:00:00", "2024-01-17 00:00:00")


def zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.zoom(b.daily(spark, sf_dir), 7), 2)


def box_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = staged(b.sales_predictions(spark, sf_dir).select("series_id", "ts", "y_true"))
    return b.rounded(ex.box_statistics(sales, ("month", "day_of_week"), "y_true"), 4)


def box_statistics_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.box_statistics(_hourly(spark, sf_dir)), 4)


def rolling_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.rolling_statistics(b.hourly(spark, sf_dir)))


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.histogram(_sales_residuals(spark, sf_dir), 60, "residual"), 4)


def load_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.load_heatmap(b.records(spark, sf_dir)))


def monthly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.monthly_profile(b.sales_predictions(spark, sf_dir), "y_true"), 4)


def decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.decompose(b.hourly(spark, sf_dir), 24).drop("phase"), 7)


def decompose_week_of_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.decompose(b.hourly(spark, sf_dir), 168).drop("phase"), 6)


def decompose_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.decompose(b.daily(spark, sf_dir), 7, step=DAY).drop("phase"), 3)


def qq_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.qq_points(_sales_residuals(spark, sf_dir)), 4)


def qq_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.qq_points(_sales_residuals(spark, sf_dir), points=500), 4)


def qq_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.qq_line(ex.qq_points(_sales_residuals(spark, sf_dir))), 3)


def actual_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ex.actual_vs_predicted(b.naive_predictions(spark, sf_dir), ["naive_lag24", "naive_lag1"], "2024-01-24"))


def nearest_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.nearest_week(b.sales_predictions(spark, sf_dir), "1999-02-08")


def week_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.week_grid(b.records(spark, sf_dir))


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.dataset_summary(b.sales_predictions(spark, sf_dir))


def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = staged(b.sales_predictions(spark, sf_dir).select("series_id", "y_true", "y_pred"))
    return b.rounded(ex.describe(sales, ["y_true", "y_pred"]), 5)


def sort_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = mt.leaderboard(b.sales_predictions(spark, sf_dir), 30000.0)
    return b.rounded(mt.sort_leaderboard(board, "smape").select("series_id", "model", "horizon", "smape"), 4)


# --- monitoring -------------------------------------------------------------------------------


def population_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mn.population_stability(b.records(spark, sf_dir), "y", b.TEST_START))


def kolmogorov_smirnov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mn.kolmogorov_smirnov(b.records(spark, sf_dir), "y", b.TEST_START))


def rolling_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.rolling_errors(b.naive_predictions(spark, sf_dir), 24, 200.0), 8)


def retrain_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.records(spark, sf_dir)
    drift = mn.population_stability(rows, "y", b.TEST_START, threshold=0.0105)
    errors = mt.evaluate(b.naive_predictions(spark, sf_dir).where(F.col("model") == "naive_lag24"), 160.0)
    return mn.retrain_decision(drift, errors, "2024-01-31", "2024-01-10")


def _fitted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive predictions with the time of the fit in use: lag 24 is renewed in time, lag 1 late, lag 168 never."""
    day, model = F.col("ts"), F.col("model")
    renewed = ((model == "naive_lag24") & (day >= F.lit("2024-01-25"))) | ((model == "naive_lag1") & (day >= F.lit("2024-01-27")))
    fitted = F.when(renewed, F.lit("2024-01-24")).otherwise(F.lit("2024-01-10")).cast("timestamp_ntz")
    return b.naive_predictions(spark, sf_dir).withColumn("fitted_at", fitted)


_ALERTS = {"scale": 200.0, "window": 24, "limit": 1.0, "hold": 6, "max_age_days": 16}


def retrain_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mn.retrain_alerts(_fitted_predictions(spark, sf_dir), **_ALERTS)


def retrain_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same alerts from a stream over the stored predictions, up to its last watermark."""
    source, sink, state = (scratch_path(spark, n) for n in ("predictions", "alerts", "alert-state"))
    made = _fitted_predictions(spark, sf_dir)
    made.write.parquet(source)
    before = spark.conf.get(alerts.PROVIDER)
    spark.conf.set(alerts.PROVIDER, alerts.ROCKS_DB)
    try:
        found = alerts.retrain_alerts_stream(spark.readStream.schema(made.schema).parquet(source), **_ALERTS, lateness="90 minutes")
        found.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(alerts.PROVIDER, before)
    return spark.read.schema(found.schema).parquet(sink)


def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-ahead scoring of all origins with one stored model."""
    matrix = staged(ft.direct_matrix(b.featured(spark, sf_dir)))
    model = boosting.fit_direct(matrix, ft.feature_names(matrix), params=SMALL)
    path = tables.save_model(model, scratch_path(spark, "model"))
    last_day = matrix.where(F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz"))
    return boosting.score(tables.load_model(path), last_day, "boosted_h24", "h=24")


# --- SQL --------------------------------------------------------------------------------------


def _alerts_sql(until: str) -> str:
    return f"""WITH {b.NAIVE}, e AS (SELECT *, avg(abs(y_true - y_pred)) OVER f AS mae, count(abs(y_true - y_pred)) OVER f AS n,
        CASE WHEN (model = 'naive_lag24' AND ts >= TIMESTAMP '2024-01-25') OR (model = 'naive_lag1' AND ts >= TIMESTAMP '2024-01-27')
            THEN TIMESTAMP '2024-01-24' ELSE TIMESTAMP '2024-01-10' END AS fitted_at
        FROM naive WINDOW f AS (PARTITION BY series_id, model ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
    h AS (SELECT *, n = 24 AND mae / 200 >= 1 AS hot, row_number() OVER (PARTITION BY series_id, model ORDER BY ts) AS rn FROM e),
    i AS (SELECT *, rn - row_number() OVER (PARTITION BY series_id, model, hot ORDER BY ts) AS island FROM h),
    q AS (SELECT series_id, model, 'error' AS kind, nth_value(ts, 6) OVER w AS ts, first_value(ts) OVER w AS since FROM i WHERE hot
            WINDOW w AS (PARTITION BY series_id, model, island ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
        UNION SELECT series_id, model, 'age', due, fitted_at FROM (
            SELECT series_id, model, fitted_at, fitted_at + INTERVAL 16 DAY AS due, lead(min(ts)) OVER (PARTITION BY series_id, model ORDER BY min(ts)) AS following
            FROM e GROUP BY 1, 2, 3) WHERE following IS NULL OR due < following),
    l AS (SELECT series_id, model, max(ts) AS z FROM naive GROUP BY 1, 2)
    SELECT q.series_id, q.model, kind, q.ts, since FROM q JOIN l USING (series_id, model) WHERE {until}"""


def _kruskal_sql(source: str, level: str, value: str, factor: str, extra: str) -> str:
    return f"""x AS (SELECT series_id, {level} AS g, {value} AS v FROM {source}),
    ranked AS (SELECT series_id, g, v, rank() OVER (PARTITION BY series_id ORDER BY v) + (count(*) OVER (PARTITION BY series_id, v) - 1) / 2.0 AS rk FROM x),
    s AS (SELECT series_id, sum(r * r / n) AS s, sum(n) AS n, count(*) AS k FROM (SELECT series_id, g, sum(rk) AS r, count(*) AS n FROM ranked GROUP BY 1, 2) GROUP BY 1),
    t AS (SELECT series_id, sum(c * c * c - c) AS t FROM (SELECT series_id, v, count(*)::DOUBLE AS c FROM x GROUP BY 1, 2) GROUP BY 1)
    SELECT series_id, '{factor}' AS factor, {b.r('statistic', 4, '(12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (n::DOUBLE * n * n - n))')}{extra} FROM s JOIN t USING (series_id)"""


_ACF = f"""{b.HOURLY}, m AS (SELECT series_id, avg(y) AS m, count(*) AS n FROM hourly GROUP BY 1),
e AS (SELECT series_id, rn, n, y - m AS e FROM hourly JOIN m USING (series_id)),
c AS (SELECT a.series_id, a.n, a.rn - z.rn AS lag, sum(a.e * z.e) AS c FROM e a JOIN e z ON a.series_id = z.series_id AND z.rn BETWEEN a.rn - 168 AND a.rn GROUP BY 1, 2, 3),
acf AS (SELECT series_id, n, lag, c / max(CASE WHEN lag = 0 THEN c END) OVER (PARTITION BY series_id) AS acf FROM c)"""

_RES = f"{b.SALES}, res AS (SELECT series_id, model, ts, y_true, y_true - y_pred AS residual FROM sales)"


def _box_sql(source: str, value: str, factors: list[tuple[str, str]]) -> str:
    levels = " UNION ALL ".join(f"SELECT series_id, '{f}' AS factor, {e} AS level, {value} AS v FROM {source}" for f, e in factors)
    return f"""long AS ({levels}),
    q AS (SELECT series_id, factor, level, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1, 2, 3),
    f AS (SELECT *, v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM long JOIN q USING (series_id, factor, level))
    SELECT series_id, factor, level, n, {b.r('q1', 4)}, {b.r('median', 4)}, {b.r('q3', 4)}, {b.r('whisker_low', 4, 'min(v) FILTER (WHERE inside)')},
        {b.r('whisker_high', 4, 'max(v) FILTER (WHERE inside)')}, count(*) FILTER (WHERE NOT inside) AS n_outliers FROM f GROUP BY series_id, factor, level, n, q1, median, q3"""


_ROLL_EX = ", ".join(
    f"CASE WHEN count(y) OVER f{w} = {w} THEN {e}(y) OVER f{w} END AS {n}"
    for n, e, w in (("mean_daily", "avg", 24), ("mean_weekly", "avg", 168), ("std_weekly", "stddev_samp", 168))
)


def _decompose_sql(source: str, cte: str, period: int, digits: int) -> str:
    half = period // 2
    if period % 2:
        trend = f"CASE WHEN count(y) OVER f = {period} THEN avg(y) OVER f END"
    else:
        trend = f"CASE WHEN count(y) OVER f = {period + 1} THEN (sum(y) OVER f - (lag(y, {half}) OVER w + lead(y, {half}) OVER w) / 2) / {period} END"
    return f"""WITH {cte}, p AS (SELECT series_id, ts, y, row_number() OVER w - 1 AS pos, {trend} AS trend FROM {source}
        WINDOW w AS (PARTITION BY series_id ORDER BY ts), f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)),
    ph AS (SELECT series_id, pos % {period} AS phase, avg(y - trend) AS p FROM p GROUP BY 1, 2),
    se AS (SELECT series_id, phase, p - avg(p) OVER (PARTITION BY series_id) AS seasonal FROM ph)
    SELECT p.series_id, ts, {b.r('y', digits)}, {b.r('trend', digits)}, {b.r('seasonal', digits)}, {b.r('remainder', digits, 'y - trend - seasonal')}
    FROM p JOIN se ON p.series_id = se.series_id AND pos % {period} = phase"""


_KPSS = f"""{_ACF.replace("a.rn - 168", "a.rn - 400")}, p AS (SELECT *, floor(pow(n, 2 / 9) + 1e-12) AS pilot FROM c),
s AS (SELECT series_id, n, sum(CASE WHEN lag = 0 THEN c / n WHEN lag <= pilot THEN 2 * c / n END) AS s0,
    sum(CASE WHEN lag BETWEEN 1 AND pilot THEN lag * 2 * c / n END) AS s1 FROM p GROUP BY 1, 2),
l AS (SELECT *, least(floor(1.1447 * pow(pow(s1 / s0, 2), 1 / 3) * pow(n, 1 / 3)), n - 1) AS lags FROM s),
v AS (SELECT c.series_id, any_value(l.n) AS n, any_value(lags) AS lags,
    sum(CASE WHEN lag = 0 THEN c WHEN lag <= lags THEN 2 * c * (1 - lag / (lags + 1)) END) / any_value(l.n) AS longrun FROM c JOIN l USING (series_id) GROUP BY 1),
q AS (SELECT series_id, sum(w * w) AS sq FROM (SELECT series_id, sum(e) OVER (PARTITION BY series_id ORDER BY rn) AS w FROM e) GROUP BY 1),
kpss AS (SELECT series_id, sq / (n * n) / longrun AS k, CAST(lags AS BIGINT) AS kpss_lags FROM v JOIN q USING (series_id))
SELECT series_id, {b.r('kpss_stat', 6, 'k')}, {b.r('kpss_pvalue', 6, """CASE WHEN k <= 0.347 THEN 0.10 WHEN k <= 0.463 THEN 0.10 - (k - 0.347) * 0.05 / 0.116
    WHEN k <= 0.574 THEN 0.05 - (k - 0.463) * 0.025 / 0.111 WHEN k <= 0.739 THEN 0.025 - (k - 0.574) * 0.015 / 0.165 ELSE 0.01 END""")}, kpss_lags FROM kpss"""



def _swept(name: str, source: str) -> str:
    """A recursive CTE that eliminates one regressor after the other from a matrix ``a`` of K x K numbers."""
    cell = "a[q + 1] - a[(q // K) * K + k_] * a[(k_ - 1) * K + q % K + 1] / a[(k_ - 1) * K + k_]"
    return f"""{name} AS (SELECT series_id, n, M, p, K, a, 1 AS k_ FROM {source} UNION ALL
    SELECT series_id, n, M, p, K, list_transform(range(0, K * K), lambda q: CASE WHEN q // K + 1 > k_ AND q % K + 1 > k_ THEN {cell} ELSE 0 END) AS a, k_ + 1 FROM {name} WHERE k_ < K)"""


def _gram_sql(name: str, source: str) -> str:
    """Sums of products of all pairs of entries of the vectors ``v``, as one list per series."""
    return f"""{name} AS (SELECT series_id, n, M, p, K, list(s ORDER BY i, j) AS a FROM (
    SELECT series_id, n, M, p, len(v) AS K, i, j, sum(v[i] * v[j]) AS s FROM {source}, range(1, 200) AS x(i), range(1, 200) AS y(j)
    WHERE i <= len(v) AND j <= len(v) GROUP BY ALL) GROUP BY ALL)"""


_ADF = f"""RECURSIVE {b.HOURLY},
adf_x AS (SELECT series_id, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS t, count(*) OVER w AS n, avg(y) OVER w AS m, stddev_pop(y) OVER w AS s
    FROM hourly WHERE y IS NOT NULL WINDOW w AS (PARTITION BY series_id)),
adf_z AS (SELECT series_id, n, t, (y - m) / s AS z FROM adf_x),
adf_l AS (SELECT series_id, n, CAST(least(ceil(12 * pow(n / 100, 0.25)), n // 2 - 2) AS BIGINT) AS M, list(z ORDER BY t) AS z, list(d ORDER BY t) AS d
    FROM (SELECT *, z - lag(z) OVER (PARTITION BY series_id ORDER BY t) AS d FROM adf_z) GROUP BY ALL),
adf_v AS (SELECT series_id, n, M, 0 AS p, list_concat([1.0, z[t - 1]], list_transform(range(1, M + 1), lambda o: d[t - o]), [d[t]]) AS v
    FROM adf_l, range(1, 100000) AS r(t) WHERE t BETWEEN M + 2 AND n),
{_gram_sql('adf_g', 'adf_v')},
{_swept('adf_s', 'adf_g')},
adf_c AS (SELECT series_id, n, M, k_ - 3 AS p, a[K * K] AS ssr, n - 1 - M AS common FROM adf_s WHERE k_ >= 3),
adf_p AS (SELECT series_id, n, M, p FROM adf_c WHERE ssr > 0
    QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY common * ln(ssr / common) + 2 * (p + 2), p) = 1),
adf_o AS (SELECT l.series_id, l.n, l.M, p, list_concat([1.0], list_transform(range(1, p + 1), lambda o: d[t - o]), [z[t - 1], d[t]]) AS v
    FROM adf_l l JOIN adf_p USING (series_id), range(1, 100000) AS r(t) WHERE t BETWEEN p + 2 AND l.n),
{_gram_sql('adf_h', 'adf_o')},
{_swept('adf_t', 'adf_h')},
adf_f AS (SELECT series_id, n, p, a[(K - 2) * K + K - 1] AS zz, a[(K - 2) * K + K] AS zy, a[K * K] AS yy FROM adf_t WHERE k_ = K - 1)
SELECT series_id, {b.r('adf_stat', 6, 'zy / zz / sqrt((yy - zy * zy / zz) / (n - 1 - p - (p + 2)) / zz)')}, p AS adf_lags FROM adf_f"""

_PACF = f"""RECURSIVE {_ACF}, r AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM acf GROUP BY 1),
d AS (SELECT series_id, r, 1 AS k, [r[2]] AS phi, 1 - r[2] * r[2] AS v FROM r
    UNION ALL SELECT series_id, r, k + 1, list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - last * phi[k + 1 - j]), [last]), v * (1 - last * last) FROM (
        SELECT *, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j]))) / v AS last FROM d WHERE k < 168))
SELECT series_id, CAST(k AS INTEGER) AS lag, {b.r('pacf', 6, 'phi[k]')} FROM d UNION ALL SELECT series_id, 0, 1.0 FROM r"""


def _horner(x: str, coefficients: list[float]) -> str:
    text = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def _normal_sql(p: str) -> str:
    q, t = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    centre = f"{q} * {_horner(f'(0.180625 - {q} * {q})', ds.CENTRE_NUM)} / {_horner(f'(0.180625 - {q} * {q})', ds.CENTRE_DEN)}"
    middle = f"{_horner(f'({t} - 1.6)', ds.MIDDLE_NUM)} / {_horner(f'({t} - 1.6)', ds.MIDDLE_DEN)}"
    tail = f"{_horner(f'({t} - 5)', ds.TAIL_NUM)} / {_horner(f'({t} - 5)', ds.TAIL_DEN)}"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {centre} ELSE sign({q}) * CASE WHEN {t} <= 5 THEN {middle} ELSE {tail} END END"


_QQ = f"""{_RES}, o AS (SELECT series_id, model, residual AS ordered, row_number() OVER (PARTITION BY series_id, model ORDER BY residual) AS i,
    count(*) OVER (PARTITION BY series_id, model)::DOUBLE AS n FROM res),
pos AS (SELECT *, CASE WHEN i = n THEN pow(0.5, 1 / n) WHEN i = 1 THEN 1 - pow(0.5, 1 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o),
qq AS (SELECT series_id, model, i, ordered, {_normal_sql('p')} AS theoretical FROM pos)"""

_KS = f"""{b.RECORDS}, t AS (SELECT series_id, y AS v, ts < TIMESTAMP '{b.TEST_START}' AS ref FROM records),
n AS (SELECT series_id, count(*) FILTER (WHERE ref) AS n_reference, count(*) FILTER (WHERE NOT ref) AS n_current FROM t GROUP BY 1),
d AS (SELECT series_id, v, sum(CASE WHEN ref THEN 1.0 / n_reference ELSE -1.0 / n_current END) AS d FROM t JOIN n USING (series_id) GROUP BY 1, 2),
g AS (SELECT series_id, sum(d) OVER (PARTITION BY series_id ORDER BY v) AS g FROM d)"""
_PSI = f"""{b.RECORDS}, t AS (SELECT series_id, y AS v, ts < TIMESTAMP '{b.TEST_START}' AS ref FROM records),
e AS (SELECT series_id, min(v) AS lo, max(v) - min(v) AS span FROM t WHERE ref GROUP BY 1),
c AS (SELECT series_id, greatest(0, least(9, floor((v - lo) / span * 10))) AS bin, count(*) FILTER (WHERE ref) AS r, count(*) FILTER (WHERE NOT ref) AS c FROM t JOIN e USING (series_id) GROUP BY 1, 2),
full_bins AS (SELECT series_id, bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM (SELECT series_id, unnest(range(0, 10)) AS bin FROM e) LEFT JOIN c USING (series_id, bin)),
sh AS (SELECT series_id, greatest(r / sum(r) OVER (PARTITION BY series_id), 1e-4) AS rs, greatest(c / sum(c) OVER (PARTITION BY series_id), 1e-4) AS cs FROM full_bins),
psi AS (SELECT series_id, sum((cs - rs) * ln(cs / rs)) AS psi FROM sh GROUP BY 1)"""

QUERIES: dict[str, tuple[b.Query, str | None]] = {
    "st1_kruskal_hour": (kruskal_hour, f"WITH {b.HOURLY}, " + _kruskal_sql("hourly", "hour(ts)", "y", "hour", ", (12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (n::DOUBLE * n * n - n)) > 35.17246162690806 AS significant")),
    "st1_kruskal_month": (kruskal_month, f"WITH {b.SALES}, " + _kruskal_sql("sales", "month(ts)", "y_true", "month", "")),
    "st2_acf": (
        acf,
        f"""WITH {_ACF} SELECT series_id, lag, {b.r('acf')}, {b.r('band', 6, '''CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
            OVER (PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END''')} FROM acf""",
    ),
    "st3_pacf": (pacf, f"WITH {_PACF}"),
    "st4_ljung_box": (
        ljung_box,
        f"""WITH {_ACF}, q AS (SELECT series_id, lag, n * (n + 2) * sum(acf * acf / (n - lag)) OVER (PARTITION BY series_id ORDER BY lag) AS statistic FROM acf WHERE lag > 0)
        SELECT series_id, lag, {b.r('statistic', 4)} FROM q WHERE lag IN (24, 48, 168)""",
    ),
    "st5_adf": (adf, None),
    "st5_adf_orders": (adf_orders, f"WITH {_ADF}"),
    "st6_kpss": (kpss, f"WITH {_KPSS}"),
    "st6_kpss_dead_meter": (
        kpss_dead_meter,
        f"WITH {_KPSS} UNION ALL SELECT DISTINCT 'dead ' || series_id, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT) FROM hourly",
    ),
    "st7_verdict": (
        verdict,
        f"""WITH p AS (SELECT event_id, value / 5000 AS adf_pvalue, event_id % 100 / 1000 AS kpss_pvalue FROM events),
        q AS (SELECT *, adf_pvalue < 0.05 AS adf_stationary, kpss_pvalue >= 0.05 AS kpss_stationary FROM p)
        SELECT event_id, {b.r('adf_pvalue', 8)}, {b.r('kpss_pvalue', 8)}, adf_stationary, kpss_stationary,
            CASE WHEN adf_stationary AND kpss_stationary THEN 'stationary' WHEN NOT adf_stationary AND NOT kpss_stationary THEN 'non-stationary' ELSE 'inconclusive' END AS verdict FROM q""",
    ),
    "st8_stationarity_pair": (stationarity, None),
    "st9_summarize": (summarize, None),
    "ex1_slice_between": (
        slice_between,
        f"WITH {b.RECORDS} SELECT series_id, ts, y, event_id FROM records WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-17'",
    ),
    "ex2_zoom": (
        zoom,
        f"""WITH {b.DAILY}, s AS (SELECT series_id, min(ts) + INTERVAL 30 DAY AS a FROM daily GROUP BY 1)
        SELECT series_id, ts, {b.r('y', 2)} FROM daily JOIN s USING (series_id) WHERE ts BETWEEN a AND a + INTERVAL 7 DAY""",
    ),
    "ex3_box_statistics": (box_statistics, f"WITH {b.SALES}, " + _box_sql("sales", "y_true", [("month", "month(ts)"), ("day_of_week", "isodow(ts) - 1")])),
    "ex3_box_statistics_hourly": (
        box_statistics_hourly,
        f"WITH {b.HOURLY}, " + _box_sql("hourly", "y", [("hour", "hour(ts)"), ("day_of_week", "isodow(ts) - 1"), ("month", "month(ts)")]),
    ),
    "ex4_rolling_statistics": (
        rolling_statistics,
        f"""WITH {b.HOURLY}, x AS (SELECT series_id, ts, y, {_ROLL_EX} FROM hourly WINDOW
            f24 AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), f168 AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW))
        SELECT series_id, ts, {b.r('y')}, {b.r('mean_daily')}, {b.r('mean_weekly')}, {b.r('std_weekly')}, {b.r('band_low', 6, 'mean_weekly - std_weekly')}, {b.r('band_high', 6, 'mean_weekly + std_weekly')} FROM x""",
    ),
    "ex5_histogram": (
        histogram,
        f"""WITH {_RES}, e AS (SELECT series_id, min(residual) AS lo, max(residual) - min(residual) AS span FROM res GROUP BY 1),
        c AS (SELECT series_id, CAST(least(floor((residual - lo) / span * 60), 59) AS INTEGER) AS bin, count(*) AS n FROM res JOIN e USING (series_id) GROUP BY 1, 2),
        g AS (SELECT series_id, lo, span, CAST(unnest(range(0, 60)) AS INTEGER) AS bin FROM e)
        SELECT series_id, bin, {b.r('bin_low', 4, 'lo + bin * (span / 60)')}, {b.r('bin_high', 4, 'lo + (bin + 1) * (span / 60)')}, coalesce(n, 0) AS n, {b.r('log10_count', 4, 'log10(n)')}
        FROM g LEFT JOIN c USING (series_id, bin)""",
    ),
    "ex6_load_heatmap": (
        load_heatmap,
        f"WITH {b.RECORDS} SELECT series_id, hour(ts) AS hour, " + ", ".join(b.r(f"dow_{d}", 6, f"avg(y) FILTER (WHERE isodow(ts) = {d + 1})") for d in range(7)) + " FROM records GROUP BY 1, 2",
    ),
    "ex7_monthly_profile": (
        monthly_profile,
        f"""WITH {b.SALES}, m AS (SELECT series_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, avg(y_true) AS mean FROM sales GROUP BY 1, 2),
        g AS (SELECT series_id, unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)) AS month_start FROM m GROUP BY 1)
        SELECT series_id, month_start, {b.r('mean', 4)} FROM g LEFT JOIN m USING (series_id, month_start)""",
    ),
    "ex8_decompose": (decompose, _decompose_sql("hourly", b.HOURLY, 24, 7)),
    "ex8_decompose_week_of_hours": (decompose_week_of_hours, _decompose_sql("hourly", b.HOURLY, 168, 6)),
    "ex8_decompose_weekly": (decompose_weekly, _decompose_sql("daily", b.DAILY, 7, 3)),
    "ex9_qq_points": (qq_points, f"WITH {_QQ} SELECT series_id, model, i, {b.r('ordered', 4)}, {b.r('theoretical', 4)} FROM qq"),
    "ex9_qq_selected": (
        qq_selected,
        f"""WITH {_QQ}, s AS (SELECT DISTINCT series_id, model, 1 + ((k - 1) * (n::BIGINT - 1)) // 499 AS i
            FROM (SELECT series_id, model, count(*) AS n FROM o GROUP BY 1, 2), range(1, 501) AS g(k) WHERE n > 500)
        SELECT series_id, model, i, {b.r('ordered', 4)}, {b.r('theoretical', 4)} FROM qq SEMI JOIN s USING (series_id, model, i)""",
    ),
    "ex9_qq_line": (
        qq_line,
        f"WITH {_QQ} SELECT series_id, model, {b.r('slope', 3, 'regr_slope(ordered, theoretical)')}, {b.r('intercept', 3, 'regr_intercept(ordered, theoretical)')}, {b.r('r', 3, 'corr(ordered, theoretical)')} FROM qq GROUP BY 1, 2",
    ),
    "ex10_actual_vs_predicted": (
        actual_vs_predicted,
        f"""WITH {b.NAIVE} SELECT series_id, ts, {b.r('y_true', 6, "max(y_true) FILTER (WHERE model = 'naive_lag24')")}, {b.r('naive_lag24', 6, "max(y_pred) FILTER (WHERE model = 'naive_lag24')")},
        {b.r('naive_lag1', 6, "max(y_pred) FILTER (WHERE model = 'naive_lag1')")} FROM naive WHERE ts BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31' GROUP BY 1, 2""",
    ),
    "ex11_week_grid": (
        week_grid,
        f"WITH {b.RECORDS} SELECT series_id, unnest(generate_series(date_trunc('day', min(ts))::TIMESTAMP, max(ts), INTERVAL 7 DAY)) AS week_start FROM records GROUP BY 1",
    ),
    "ex11_nearest_week": (
        nearest_week,
        f"""WITH {b.SALES}, w AS (SELECT series_id, unnest(generate_series(date_trunc('day', min(ts))::TIMESTAMP, max(ts)::TIMESTAMP, INTERVAL 7 DAY)) AS week_start FROM sales GROUP BY 1)
        SELECT series_id, arg_min(week_start, abs(date_diff('second', TIMESTAMP '1999-02-08', week_start)) * 2 + (week_start > TIMESTAMP '1999-02-08')::INT) AS week_start FROM w GROUP BY 1""",
    ),
    "ex12_dataset_summary": (
        dataset_summary,
        f"WITH {b.SALES} SELECT series_id, count(*) AS n_rows, CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date FROM sales GROUP BY 1",
    ),
    "ex12_describe": (
        describe,
        f"WITH {b.SALES} " + " UNION ALL ".join(
            f"""SELECT series_id, '{c}' AS "column", count({c}) AS count, {b.r('mean', 5, f'avg({c})')}, {b.r('std', 5, f'stddev_samp({c})')}, {b.r('min', 5, f'min({c})')},
            {b.r('p25', 5, f'quantile_cont({c}, 0.25)')}, {b.r('p50', 5, f'quantile_cont({c}, 0.5)')}, {b.r('p75', 5, f'quantile_cont({c}, 0.75)')}, {b.r('max', 5, f'max({c})')} FROM sales GROUP BY 1"""
            for c in ("y_true", "y_pred")
        ),
    ),
    "ex13_sort_leaderboard": (
        sort_leaderboard,
        f"WITH {b.SALES} SELECT series_id, model, horizon, {b.r('smape', 4, 'avg(CASE WHEN abs(y_true) + abs(y_pred) = 0 THEN 0 ELSE 2 * abs(y_true - y_pred) / (abs(y_true) + abs(y_pred)) END) * 100')} FROM sales GROUP BY 1, 2, 3",
    ),
    "mn1_population_stability": (population_stability, f"WITH {_PSI} SELECT series_id, {b.r('psi')}, psi > 0.2 AS drift FROM psi"),
    "mn1_kolmogorov_smirnov": (kolmogorov_smirnov, f"WITH {_KS} SELECT series_id, n_reference, n_current, {b.r('ks', 6, 'max(abs(g))')} FROM g JOIN n USING (series_id) GROUP BY 1, 2, 3"),
    "mn2_rolling_errors": (
        rolling_errors,
        f"""WITH {b.NAIVE}, x AS (SELECT series_id, model, ts, CASE WHEN count(*) OVER f = 24 THEN avg(abs(y_true - y_pred)) OVER f END AS rolling_mae FROM naive
            WINDOW f AS (PARTITION BY series_id, model ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
        SELECT series_id, model, ts, {b.r('rolling_mae', 8)}, {b.r('rolling_mase', 8, 'rolling_mae / 200')} FROM x""",
    ),
    "mn3_retrain_decision": (
        retrain_decision,
        f"""WITH {_PSI}, {b.NAIVE.replace(b.RECORDS + ', ', '', 1)}, m AS (SELECT series_id, avg(abs(y_true - y_pred)) / 160 AS mase FROM naive WHERE model = 'naive_lag24' GROUP BY 1)
        SELECT series_id, psi > 0.0105 AS drift, mase >= 1 AS mase_breach, false AS too_old, psi > 0.0105 OR mase >= 1 AS retrain,
            CASE WHEN psi > 0.0105 THEN 'drift' WHEN mase >= 1 THEN 'mase' ELSE 'none' END AS reason FROM psi JOIN m USING (series_id)""",
    ),
    "mn3_retrain_alerts": (retrain_alerts, _alerts_sql("q.ts <= l.z")),
    "mn3_retrain_alerts_stream": (
        retrain_alerts_stream,
        _alerts_sql("q.ts <= (SELECT max(ts) FROM naive) - INTERVAL 90 MINUTE"),
    ),
    "mn4_batch_scoring": (batch_scoring, None),
}
