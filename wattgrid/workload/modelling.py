"""Features, forecasts, errors and validation."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattgrid.functions.timeaxis import DAY
from wattgrid.operators import arma, boosting, features as ft, forecast, metrics as mt, nightly, trees, validation
from wattgrid.session import scratch_path, staged
from wattgrid.sources import tables
from wattgrid.workload import base as b

SMALL = boosting.BoostParams(rounds=4, depth=3, rate=0.3, min_rows=5, max_bins=32)
PERIOD = 24


# --- features ---------------------------------------------------------------------------------


def _stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events").select("event_id", "ts")


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.add_calendar_features(_stamps(spark, sf_dir))


def cyclical_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.add_cyclical_encodings(_stamps(spark, sf_dir)), 8)


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.add_lag_features(b.daily(spark, sf_dir), [1, 7, 28], step=DAY), 2)


def lag_features_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ft.add_lag_features(b.hourly_gappy(spark, sf_dir), [1, 24, 168], rows=256, gaps="rows")
    return b.rounded(found.select("series_id", "ts", "y", "lag_1", "lag_24", "lag_168"))


def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.add_rolling_features(b.hourly(spark, sf_dir)))


def holiday_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("ts"))
    return ft.add_holiday_flag(orders)


def build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.build_features(b.hourly(spark, sf_dir)))


def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.chronological_split(b.daily(spark, sf_dir), b.DAILY_TEST_START).groupBy("series_id", "split").agg(F.count(F.lit(1)).alias("n"))


def count_warmup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.count_warmup(ft.build_features(b.hourly(spark, sf_dir)))


def model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.model_matrix(b.featured(spark, sf_dir)))


def direct_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.direct_matrix(b.featured(spark, sf_dir)))


NIGHTS = ["2024-01-27", "2024-01-28", "2024-01-29"]


def night_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nights in turn; each reads the stored tail and its own day, and stores the next tail."""
    hourly = staged(b.hourly(spark, sf_dir).select("series_id", "ts", "y"))
    state = staged(nightly.tail_state(hourly.where(F.col("ts") < F.lit(NIGHTS[0]))))
    made = []
    for night in NIGHTS:
        begin = F.lit(night).cast("timestamp_ntz")
        day = hourly.where((F.col("ts") >= begin) & (F.col("ts") < begin + F.expr("interval '1' day")))
        made.append(nightly.night_matrix(state, day).drop("split"))
        state = staged(nightly.merge_tails(state, nightly.tail_state(day)))
    return b.rounded(made[0].unionByName(made[1]).unionByName(made[2]))


def lookback_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ft.lookback_windows(b.hourly(spark, sf_dir), start=b.TEST_START)
    return b.rounded(made.select("series_id", "ts", "y", F.size("window").cast("bigint").alias("n"), F.element_at("window", 1).alias("oldest"),
                                 F.element_at("window", -1).alias("newest"), F.aggregate("window", F.lit(0.0), lambda a, v: a + v).alias("total")), 4)


def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ft.context_windows(b.hourly(spark, sf_dir), 24, 256, start=b.TEST_START)
    return b.rounded(made.select("series_id", "ts", "y", F.size("context").cast("bigint").alias("n"), F.element_at("context", 1).alias("oldest"),
                                 F.element_at("context", -1).alias("newest")), 4)


def context_windows_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts of 1,024 days for every day that has one."""
    made = ft.context_windows(b.daily(spark, sf_dir), 24, 1024, strict=False, step=DAY)
    weighted = F.aggregate(F.zip_with("context", F.sequence(F.lit(1), F.lit(1024)), lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v)
    return b.rounded(made.select("series_id", "ts", "y", F.element_at("context", 1).alias("oldest"), F.element_at("context", 512).alias("middle"),
                                 F.element_at("context", -1).alias("newest"), (weighted / 1e6).alias("weighted")), 3)


def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = ft.chronological_split(b.hourly(spark, sf_dir), b.TEST_START)
    fitted = ft.scaler(split)
    scaled = ft.standardise(split, fitted)
    return b.rounded(ft.unstandardise(scaled, fitted, name="back"))


def seasonal_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(ft.seasonal_difference(b.hourly(spark, sf_dir)))


def feature_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = ft.model_matrix(b.featured(spark, sf_dir))
    return b.rounded(ft.feature_bounds(matrix, ft.feature_names(matrix)))


def recent_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = ft.chronological_split(b.daily(spark, sf_dir), b.DAILY_TEST_START).where(F.col("split") == "train")
    return b.rounded(ft.recent_tail(train, 90, step=DAY).drop("split"), 2)


# --- forecasts --------------------------------------------------------------------------------


def naive_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(b.naive_predictions(spark, sf_dir))


def _matrix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    matrix = staged(ft.model_matrix(b.featured(spark, sf_dir)))
    return matrix, ft.feature_names(matrix)


def boosted_early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix, names = _matrix(spark, sf_dir)
    model = boosting.fit_early_stopping(matrix, names, params=SMALL)
    return boosting.score(model, matrix.where(F.col("split") == "test"), "boosted")


def boosted_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = staged(ft.direct_matrix(b.featured(spark, sf_dir)))
    model = boosting.fit_direct(matrix, ft.feature_names(matrix), params=SMALL)
    return boosting.score(model, matrix.where(F.col("split") == "test"), "boosted_h24", "h=24")


def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix, names = _matrix(spark, sf_dir)
    return boosting.feature_importances(spark, boosting.fit_direct(matrix, names, params=SMALL), 15)


FIRST_FEATURES = ["lag_1", "lag_24", "lag_168", "hour", "dayofweek"]
FIRST = trees.TreeParams(rounds=2, depth=2, rate=0.5, row_share=1.0, column_share=1.0, min_weight=5, l1=0.5, l2=2.0)
FIRST_BINS = 8


def boosted_first_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two trees of a fit without draws, all candidates' rules but small enough to follow in SQL."""
    matrix = staged(b.featured(spark, sf_dir).select("series_id", "ts", "split", "y", *FIRST_FEATURES))
    model = trees.fit(matrix, FIRST_FEATURES, FIRST, bins=FIRST_BINS)
    return b.rounded(trees.score({"boosted": model}, matrix.where(F.col("split") == "test")), 4)


def _first_trees(source: str, horizon: str = "h=1") -> str:
    """The same trees on a CTE in SQL: cut points, then per level the sums by node, feature and bin, and the
    best split; the forecasts of its test rows."""
    p, n = FIRST, len(FIRST_FEATURES)
    t = lambda x: f"sign({x}) * greatest(abs({x}) - {p.l1}, 0)"
    score = lambda g, h: f"pow({t(g)}, 2) / ({h} + {p.l2})"
    parts = [
        f"every AS (SELECT row_number() OVER (ORDER BY series_id, ts) AS id, * FROM {source})",
        f"long AS (SELECT id, split, unnest(range(0, {n})) AS f, unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in FIRST_FEATURES)}]) AS x FROM every)",
        "ranked AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS rn, count(*) OVER (PARTITION BY f) AS n FROM long WHERE split = 'train')",
        f"edges AS (SELECT DISTINCT f, x AS e FROM ranked, (SELECT unnest(range(1, {FIRST_BINS})) AS k) AS ks WHERE rn = ceil(n * k / {FIRST_BINS}))",
        "binned AS (SELECT id, l.f, count(e) AS bin FROM long l LEFT JOIN edges ON l.f = edges.f AND e <= x GROUP BY 1, 2)",
        "m0 AS (SELECT id, split, y, (SELECT avg(y) FROM every WHERE split = 'train') AS p FROM every)",
    ]
    for tree in range(1, p.rounds + 1):
        node = f"n{tree}_0"
        parts.append(f"{node} AS (SELECT *, 0 AS node FROM m{tree - 1})")
        for level in range(p.depth):
            tag = f"{tree}_{level}"
            parts += [
                f"h{tag} AS (SELECT node, f, bin, sum(p - y) AS g, count(*) AS h FROM {node} JOIN binned USING (id) "
                f"WHERE split = 'train' AND node >= {2**level - 1} GROUP BY ALL)",
                f"c{tag} AS (SELECT node, f, bin, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(g) OVER v AS tg, sum(h) OVER v AS th FROM h{tag} "
                "WINDOW w AS (PARTITION BY node, f ORDER BY bin), v AS (PARTITION BY node, f))",
                f"q{tag} AS (SELECT node, f, bin, ({score('lg', 'lh')} + {score('(tg - lg)', '(th - lh)')} - {score('tg', 'th')}) / 2 AS gain "
                f"FROM c{tag} WHERE lh >= {p.min_weight} AND th - lh >= {p.min_weight})",
                f"s{tag} AS (SELECT node, f AS sf, bin AS sbin FROM (SELECT *, max(gain) OVER (PARTITION BY node) AS top FROM q{tag}) "
                "WHERE gain > 1e-12 AND gain >= top * (1 - 1e-9) QUALIFY row_number() OVER (PARTITION BY node ORDER BY f, bin) = 1)",
                f"n{tree}_{level + 1} AS (SELECT x.id, x.split, x.y, x.p, CASE WHEN sf IS NULL THEN x.node ELSE 2 * x.node + 1 + CAST(bin > sbin AS INTEGER) END AS node "
                f"FROM {node} x LEFT JOIN s{tag} s ON x.node = s.node LEFT JOIN binned b ON x.id = b.id AND s.sf = b.f)",
            ]
            node = f"n{tree}_{level + 1}"
        parts += [
            f"v{tree} AS (SELECT node, -{p.rate} * ({t('sum(p - y)')}) / (count(*) + {p.l2}) AS v FROM {node} WHERE split = 'train' GROUP BY 1)",
            f"m{tree} AS (SELECT id, split, y, p + v AS p FROM {node} JOIN v{tree} USING (node))",
        ]
    return (
        f"(WITH {', '.join(parts)} SELECT series_id, 'boosted' AS model, '{horizon}' AS horizon, ts, m.y AS y_true, p AS y_pred "
        f"FROM m{p.rounds} m JOIN every USING (id) WHERE m.split = 'test')"
    )


def early_stopping_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops after five rounds without progress on the newest tenth of each series."""
    matrix, names = _matrix(spark, sf_dir)
    model = trees.fit_early_stopping(matrix, names, trees.TreeParams(rounds=30, depth=3, rate=0.3), patience=5)
    return trees.score({"boosted": model}, matrix.where(F.col("split") == "test"))


SEARCH_ROUNDS = 2
FOLD_ROUNDS = 10


def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 20 candidates over all 5 folds at their drawn settings, but for the number of rounds."""
    matrix, names = _matrix(spark, sf_dir)
    candidates = [dataclasses.replace(p, rounds=SEARCH_ROUNDS) for p in trees.draw_params()]
    model, _ = trees.search(matrix, names, candidates)
    return trees.score({"boosted_tuned": model}, matrix.where(F.col("split") == "test"))


def long_autoregression(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split_hourly(spark, sf_dir).where("split = 'train'")
    fitted = arma.fit_long_autoregression(train)
    return b.rounded(fitted.withColumnsRenamed({f"b___w{k}": f"b_w{k}" for k in _LONG}), 5)


def seasonal_arma_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(arma.fit_seasonal_arma(_split_hourly(spark, sf_dir), fit_window=None).drop("radius"), 5)


def seasonal_arma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals joined up over blocks of 128 hours."""
    split = staged(_split_hourly(spark, sf_dir))
    return b.rounded(arma.seasonal_arma_forecast(split, arma.fit_seasonal_arma(split, fit_window=None), block=128), 4)


def reload_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix, names = _matrix(spark, sf_dir)
    test = matrix.where(F.col("split") == "test")
    model = boosting.fit_direct(matrix, names, params=SMALL)
    stored = boosting.score(model, test, "boosted")
    path = tables.save_model(model, scratch_path(spark, "model"))
    return tables.prediction_differences(stored, boosting.score(tables.load_model(path), test, "boosted"))


def _split_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.chronological_split(b.hourly(spark, sf_dir), b.TEST_START)


def seasonal_ar_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(forecast.fit_seasonal_ar(_split_hourly(spark, sf_dir), fit_window=336), 4)


def seasonal_ar(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split_hourly(spark, sf_dir)
    return b.rounded(forecast.seasonal_ar_forecast(split, forecast.fit_seasonal_ar(split)), 4)


def forecast_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(forecast.forecast_at(b.naive_predictions(spark, sf_dir), "2024-01-26 18:30:00"))


def direct_matrix_after_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain on a series whose target is missing here and there: its rows drop out of the features."""
    holed = b.hourly(spark, sf_dir).withColumn("y", F.when(F.dayofmonth("ts") * 24 + F.hour("ts") != 500, F.col("y")))
    made = ft.drop_warmup(ft.chronological_split(ft.build_features(holed, lags=[1, 24], windows=[24]), b.TEST_START))
    return b.rounded(ft.direct_matrix(made).select("series_id", "ts", "split", "y", "lag_1", "lag_24", "roll_mean_24", "roll_std_24"))


def scale_after_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = b.hourly(spark, sf_dir).withColumn("y", F.when(F.dayofmonth("ts") * 24 + F.hour("ts") != 500, F.col("y")))
    return b.rounded(mt.seasonal_naive_scale(holed.where("y IS NOT NULL")))


def forecast_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event asks for its time of day 14 days later; the next-hour and the next-day model answer."""
    features = staged(b.featured(spark, sf_dir))
    made = None
    for horizon, matrix in (("h=1", features), ("h=24", staged(ft.direct_matrix(features)))):
        model = trees.fit(matrix, FIRST_FEATURES, FIRST, bins=FIRST_BINS)
        scored = trees.score({"boosted": model}, matrix.where(F.col("split") == "test"), horizon)
        made = scored if made is None else made.unionByName(scored)
    events = b.table(spark, sf_dir, "events")
    asked = events.select("event_id", F.col("event_type").alias("series_id"), (F.col("ts") + F.expr("INTERVAL 14 DAYS")).alias("requested"))
    return b.rounded(forecast.forecast_requests(asked, staged(made)), 4)


def forecast_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(forecast.forecast_context(b.hourly(spark, sf_dir), "2024-01-26 19:00:00"))


# --- errors -----------------------------------------------------------------------------------


def _one(name: str, metric) -> b.Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return b.rounded(b.sales_predictions(spark, sf_dir).groupBy("series_id", "model").agg(metric().alias(name)), 4)

    return run


def _scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal naive scale of the daily series, one row per priority."""
    split = ft.chronological_split(b.daily(spark, sf_dir), b.DAILY_TEST_START)
    return mt.seasonal_naive_scale(split.where(F.col("split") == "train"), 7, step=DAY)


def seasonal_naive_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(_scale(spark, sf_dir), 4)


def _hourly_scale(made: DataFrame) -> DataFrame:
    return mt.seasonal_naive_scale(made.where(F.col("split") == "train"))


def mase(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = b.featured(spark, sf_dir)
    scores = mt.evaluate(forecast.naive_forecasts(made), _hourly_scale(made))
    return b.rounded(scores.select("series_id", "model", "mase"))


def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.evaluate(b.sales_predictions(spark, sf_dir), 30000.0), 4)


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which naive forecast is best per series."""
    made = b.featured(spark, sf_dir)
    return b.rounded(mt.leaderboard(forecast.naive_forecasts(made), _hourly_scale(made), ranked=True))


def error_breakdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.error_breakdowns(b.sales_predictions(spark, sf_dir)), 4)


def error_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.error_breakdown(b.naive_predictions(spark, sf_dir), "hour"))


def error_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.error_side_by_side(b.sales_predictions(spark, sf_dir), ["A", "N"], "month"), 4)


def worst_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.worst_levels(mt.error_breakdown(b.sales_predictions(spark, sf_dir), "month", ["model"]), "month"), 4)


def pick_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.pick_levels(mt.error_breakdown(b.sales_predictions(spark, sf_dir), "month"), "month", [8, 1]), 4)


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(mt.residuals(b.sales_predictions(spark, sf_dir)).groupBy("series_id", "model").agg(
        F.count("residual").alias("n"), F.avg("residual").alias("mean"), F.min("residual").alias("low"), F.max("residual").alias("high")), 4)


# --- validation -------------------------------------------------------------------------------


def _daily_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = ft.drop_warmup(ft.add_lag_features(b.daily(spark, sf_dir), [1, 7, 28], step=DAY))
    return lagged.where(F.col("ts") < F.lit(b.DAILY_TEST_START).cast("timestamp_ntz"))


def expanding_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = validation.expanding_folds(_daily_lags(spark, sf_dir).select("series_id", "ts"), step=DAY)
    return folds.groupBy("series_id", "fold", "role").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def cv_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = validation.cv_naive(_daily_lags(spark, sf_dir), [1, 7, 28], step=DAY)
    return b.rounded(folds.select("series_id", "model", "fold", "val_mae"))


def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = validation.cv_naive(_daily_lags(spark, sf_dir), [1, 7, 28], step=DAY)
    return b.rounded(mt.cv_summary(folds).select("series_id", "model", "n_folds", "cv_mae_mean", "cv_mae_std"))


def cv_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = validation.cv_naive(_daily_lags(spark, sf_dir), [1, 7, 28], step=DAY)
    return b.rounded(mt.cv_winner(mt.cv_summary(folds)))


def cv_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix, names = _matrix(spark, sf_dir)
    return trees.cross_validate(matrix, names, trees.TreeParams(rounds=FOLD_ROUNDS))


def cv_seasonal_ar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rounded(boosting.cv_seasonal_ar(staged(b.featured(spark, sf_dir).select("series_id", "ts", "y", "split"))))


# --- SQL --------------------------------------------------------------------------------------

_FEATURES = [*ft.CALENDAR_FEATURES[:-1], *b.HISTORY, "is_holiday"]
_FLOATS = {c for c in _FEATURES if c.endswith(("_sin", "_cos")) or c in b.HISTORY}


def _all(columns: list[str]) -> str:
    return ", ".join(b.r(c) if c in _FLOATS else c for c in columns)


_ERR = "abs(y_true - y_pred)"
_METRIC_SQL = {
    "mae": f"avg({_ERR})",
    "rmse": "sqrt(avg(pow(y_true - y_pred, 2)))",
    "mape": f"avg({_ERR} / abs(y_true)) FILTER (WHERE y_true <> 0) * 100",
    "smape": f"avg(CASE WHEN abs(y_true) + abs(y_pred) = 0 THEN 0 ELSE 2 * {_ERR} / (abs(y_true) + abs(y_pred)) END) * 100",
}
_SCALE = """scale AS (SELECT series_id, avg(abs(d)) AS scale FROM (
    SELECT series_id, y - lag(y, 24) OVER (PARTITION BY series_id ORDER BY ts) AS d FROM featured WHERE split = 'train') GROUP BY 1)"""
_BREAK = " UNION ALL ".join(
    f"SELECT series_id, model, '{a}' AS attribute, {e} AS level, {b.r('mae', 4, f'avg({_ERR})')} FROM sales GROUP BY 1, 2, 4"
    for a, e in (("hour", "hour(ts)"), ("dayofweek", "isodow(ts) - 1"), ("month", "month(ts)"))
)
_DLAGS = f"""{b.DAILY}, lagged AS (SELECT *, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7, lag(y, 28) OVER w AS lag_28 FROM daily
    WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
train AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n
    FROM lagged WHERE lag_28 IS NOT NULL AND ts < TIMESTAMP '{b.DAILY_TEST_START}'),
folds AS (SELECT *, f AS fold, n - (6 - f) * (n // 6) AS lo, n - (5 - f) * (n // 6) AS hi FROM train, (SELECT unnest(range(1, 6)) AS f))"""
_CV = f"""{_DLAGS}, cv AS (SELECT series_id, 'naive_lag' || k AS model, CAST(fold AS INTEGER) AS fold,
    avg(abs(y - CASE k WHEN 1 THEN lag_1 WHEN 7 THEN lag_7 ELSE lag_28 END)) AS val_mae
    FROM folds, (VALUES (1), (7), (28)) AS l(k) WHERE pos >= lo AND pos < hi GROUP BY 1, 2, 3)"""
_SUMMARY = f"""{_CV}, summary AS (SELECT series_id, model, count(*) AS n_folds, avg(val_mae) AS cv_mae_mean, stddev_pop(val_mae) AS cv_mae_std FROM cv GROUP BY 1, 2)"""
_DIRECT_COLUMNS = ", ".join(f"lag({c}, 24) OVER w AS {c}" for c in b.HISTORY)

_TERMS = ["one", "d1", "d2", "d3"]


def _solve_sql(source: str, name: str, terms: list[str] = _TERMS, target: str = "d") -> str:
    """CTEs that solve the normal equations of every series by elimination and back substitution."""
    k = len(terms)
    steps = [f"{name}0 AS (SELECT series_id, count(*) AS n_fit, "
             + ", ".join(f"sum({a} * {c}) AS a{i}{j}" for i, a in enumerate(terms) for j, c in enumerate([*terms, target])) + f" FROM {source} GROUP BY 1)"]
    for p in range(k - 1):
        cells = [f"a{i}{j} - a{i}{p} / a{p}{p} * a{p}{j} AS a{i}{j}" if i > p else f"a{i}{j}" for i in range(k) for j in range(k + 1)]
        steps.append(f"{name}{p + 1} AS (SELECT series_id, n_fit, {', '.join(cells)} FROM {name}{p})")
    source = f"{name}{k - 1}"
    for i in reversed(range(k)):
        known = "".join(f" - a{i}{j} * b_{terms[j]}" for j in range(i + 1, k))
        steps.append(f"{name}b{i} AS (SELECT *, (a{i}{k}{known}) / a{i}{i} AS b_{terms[i]} FROM {source})")
        source = f"{name}b{i}"
    return ", ".join(steps) + f", {name} AS (SELECT series_id, n_fit, {', '.join(f'b_{t}' for t in terms)} FROM {source})"


_LONG = arma.long_lags(24)
_LONG_TERMS = ["one", *[f"w{k}" for k in _LONG]]
_FIRST = f"""{b.HOURLY}, tr AS (SELECT * FROM hourly WHERE ts < TIMESTAMP '{b.TEST_START}'),
l1 AS (SELECT series_id, ts, 1.0 AS one, {', '.join(f'{"y" if k == 0 else f"lag(y, {k}) OVER w"} - lag(y, {k + 24}) OVER w AS w{k}' for k in [0, *_LONG])}
    FROM tr WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
u1 AS (SELECT * FROM l1 WHERE w49 IS NOT NULL), {_solve_sql('u1', 'fit1', _LONG_TERMS, 'w0')}"""
_SECOND = f"""{_FIRST}, seen AS (SELECT l1.*, w0 - b_one - {' - '.join(f'b_w{k} * w{k}' for k in _LONG)} AS e FROM l1 JOIN fit1 USING (series_id)),
l2 AS (SELECT series_id, ts, one, w0, w1, w24 AS wp, w25 AS wp1, lag(e, 1) OVER w AS e1, lag(e, 24) OVER w AS ep, lag(e, 25) OVER w AS ep1
    FROM seen WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
u2 AS (SELECT * FROM l2 WHERE ep1 IS NOT NULL), {_solve_sql('u2', 'fit2', arma.MODEL_TERMS, 'w0')}"""
_ARMA = f"""{_SECOND}, steps AS MATERIALIZED (SELECT series_id, ts, y, row_number() OVER w AS rn, b_e1, b_ep, b_ep1,
        (y - lag(y, 24) OVER w) - b_one - b_w1 * (lag(y, 1) OVER w - lag(y, 25) OVER w) - b_wp * (lag(y, 24) OVER w - lag(y, 48) OVER w)
        - b_wp1 * (lag(y, 25) OVER w - lag(y, 49) OVER w) AS u
    FROM hourly JOIN fit2 USING (series_id) WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
walk AS (SELECT DISTINCT series_id, 0::BIGINT AS rn, list_transform(range(25), lambda i: 0.0::DOUBLE) AS s, NULL::DOUBLE AS e FROM steps
    UNION ALL SELECT n.series_id, n.rn, list_prepend(coalesce(n.u - b_e1 * s[1] - b_ep * s[24] - b_ep1 * s[25], 0), s[1:24]),
        n.u - b_e1 * s[1] - b_ep * s[24] - b_ep1 * s[25]
    FROM walk JOIN steps n ON n.series_id = walk.series_id AND n.rn = walk.rn + 1)"""


_AR_TERMS = f"""{b.HOURLY}, terms AS (SELECT series_id, ts, y, 1.0 AS one, CASE WHEN ts < TIMESTAMP '{b.TEST_START}' THEN 'train' ELSE 'test' END AS split,
    lag(y, 24) OVER w AS base, y - lag(y, 24) OVER w AS d, lag(y, 1) OVER w - lag(y, 25) OVER w AS d1, lag(y, 24) OVER w - lag(y, 48) OVER w AS d2,
    lag(y, 25) OVER w - lag(y, 49) OVER w AS d3 FROM hourly WINDOW w AS (PARTITION BY series_id ORDER BY ts))"""


def _ar_sql(window: int) -> str:
    used = f"""used AS (SELECT * FROM terms JOIN (SELECT series_id, max(ts) AS z FROM terms WHERE split = 'train' GROUP BY 1) USING (series_id)
        WHERE split = 'train' AND d3 IS NOT NULL AND ts > z - INTERVAL {window} HOUR)"""
    return f"{_AR_TERMS}, {used}, {_solve_sql('used', 'fit')}"


QUERIES: dict[str, tuple[b.Query, str | None]] = {
    "fe1_calendar_features": (calendar_features, f"SELECT event_id, ts, {b.CALENDAR_SQL} FROM events"),
    "fe2_cyclical_encodings": (
        cyclical_encodings,
        f"WITH c AS (SELECT event_id, ts, {b.CYCLES_SQL} FROM events) SELECT event_id, ts, "
        + ", ".join(b.r(f"{n}_{f}", 8) for n in ("hour", "dayofweek", "month") for f in ("sin", "cos")) + " FROM c",
    ),
    "fe3_lag_features": (
        lag_features,
        f"""WITH {b.DAILY}, lagged AS (SELECT *, {b.lag_sql([1, 7, 28])} FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY ts))
        SELECT series_id, ts, {b.r('y', 2)}, {b.r('lag_1', 2)}, {b.r('lag_7', 2)}, {b.r('lag_28', 2)} FROM lagged""",
    ),
    "fe3_lag_features_gappy": (
        lag_features_gappy,
        f"""WITH {b.GAPPY}, lagged AS (SELECT *, {b.lag_sql([1, 24, 168])} FROM gappy WINDOW w AS (PARTITION BY series_id ORDER BY ts))
        SELECT series_id, ts, {b.r('y')}, {b.r('lag_1')}, {b.r('lag_24')}, {b.r('lag_168')} FROM lagged""",
    ),
    "fe4_rolling_features": (
        rolling_features,
        f"WITH {b.HOURLY}, rolled AS (SELECT series_id, ts, y, {b.roll_sql()} FROM hourly) SELECT series_id, ts, {b.r('y')}, "
        + ", ".join(b.r(c) for c in b.HISTORY if c.startswith("roll")) + " FROM rolled",
    ),
    "fe5_holiday_flag": (holiday_flag, f"WITH {b.EASTER}, o AS (SELECT o_orderkey, o_orderdate AS ts FROM orders) SELECT o_orderkey, ts, {b.HOLIDAY_SQL} FROM o"),
    "fe6_build_features": (
        build_features,
        f"WITH {b.BUILT} SELECT series_id, ts, {b.r('y')}, year, {_all(_FEATURES)} FROM built",
    ),
    "fe7_chronological_split": (
        chronological_split,
        f"WITH {b.DAILY} SELECT series_id, CASE WHEN ts < TIMESTAMP '{b.DAILY_TEST_START}' THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM daily GROUP BY 1, 2",
    ),
    "fe8_drop_warmup": (
        count_warmup,
        f"""WITH {b.BUILT} SELECT series_id, count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in b.HISTORY)}) AS n_dropped,
        count(*) FILTER (WHERE {' AND '.join(f'{c} IS NOT NULL' for c in b.HISTORY)}) AS n_kept FROM built GROUP BY 1""",
    ),
    "fe9_model_matrix": (model_matrix, f"WITH {b.FEATURED} SELECT series_id, ts, split, {b.r('y')}, {_all(_FEATURES)} FROM featured"),
    "fe10_direct_matrix": (
        direct_matrix,
        f"""WITH {b.FEATURED}, moved AS (SELECT series_id, ts, split, y, {', '.join(ft.CALENDAR_FEATURES)}, {_DIRECT_COLUMNS}
            FROM featured WINDOW w AS (PARTITION BY series_id ORDER BY ts))
        SELECT series_id, ts, split, {b.r('y')}, {_all([*ft.CALENDAR_FEATURES, *b.HISTORY])} FROM moved WHERE {' AND '.join(f'{c} IS NOT NULL' for c in b.HISTORY)}""",
    ),
    "mn4_night_matrix": (
        night_matrix,
        f"""WITH {b.FEATURED}, moved AS (SELECT series_id, ts, y, {', '.join(ft.CALENDAR_FEATURES)}, {_DIRECT_COLUMNS}
            FROM featured WINDOW w AS (PARTITION BY series_id ORDER BY ts))
        SELECT series_id, ts, {b.r('y')}, {_all([*ft.CALENDAR_FEATURES, *b.HISTORY])} FROM moved
        WHERE ts >= TIMESTAMP '{NIGHTS[0]}' AND ts < TIMESTAMP '{NIGHTS[-1]}' + INTERVAL 1 DAY""",
    ),
    "fe10_direct_matrix_after_loss": (
        direct_matrix_after_loss,
        f"""WITH {b.HOURLY}, holed AS (SELECT series_id, ts, CASE WHEN day(ts) * 24 + hour(ts) <> 500 THEN y END AS y FROM hourly),
        made AS (SELECT series_id, ts, y, CASE WHEN ts < TIMESTAMP '{b.TEST_START}' THEN 'train' ELSE 'test' END AS split, {b.lag_sql([1, 24])}, {b.roll_sql([24])}
            FROM holed WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
        kept AS (SELECT * FROM made WHERE lag_1 IS NOT NULL AND lag_24 IS NOT NULL AND roll_mean_24 IS NOT NULL AND roll_std_24 IS NOT NULL),
        moved AS (SELECT series_id, ts, split, y, {', '.join(f'lag({c}, 24) OVER w AS {c}' for c in ('lag_1', 'lag_24', 'roll_mean_24', 'roll_std_24'))}
            FROM kept WINDOW w AS (PARTITION BY series_id ORDER BY ts))
        SELECT series_id, ts, split, {', '.join(b.r(c) for c in ('y', 'lag_1', 'lag_24', 'roll_mean_24', 'roll_std_24'))} FROM moved WHERE lag_1 IS NOT NULL AND y IS NOT NULL""",
    ),
    "fe11_lookback_windows": (
        lookback_windows,
        f"""WITH {b.HOURLY}, x AS (SELECT series_id, ts, y, count(y) OVER f AS n, first_value(y) OVER f AS oldest, last_value(y) OVER f AS newest, sum(y) OVER f AS total
            FROM hourly WINDOW f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING))
        SELECT series_id, ts, {b.r('y', 4)}, n, {b.r('oldest', 4)}, {b.r('newest', 4)}, {b.r('total', 4)} FROM x WHERE n = 168 AND ts >= TIMESTAMP '{b.TEST_START}'""",
    ),
    "fe12_context_windows": (
        context_windows,
        f"""WITH {b.HOURLY}, x AS (SELECT series_id, ts, y, count(y) OVER f AS n, first_value(y) OVER f AS oldest, last_value(y) OVER f AS newest
            FROM hourly WINDOW f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 279 PRECEDING AND 24 PRECEDING))
        SELECT series_id, ts, {b.r('y', 4)}, n, {b.r('oldest', 4)}, {b.r('newest', 4)} FROM x WHERE ts >= TIMESTAMP '{b.TEST_START}'""",
    ),
    "fe12_context_windows_long": (
        context_windows_long,
        f"""WITH {b.DAILY}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM daily),
        x AS (SELECT series_id, ts, y, count(y) OVER f AS n, first_value(y) OVER f AS oldest, nth_value(y, 512) OVER f AS middle, last_value(y) OVER f AS newest,
            sum(y * rn) OVER f - sum(y) OVER f * (min(rn) OVER f - 1) AS weighted
            FROM n WINDOW f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 1047 PRECEDING AND 24 PRECEDING))
        SELECT series_id, ts, {b.r('y', 3)}, {b.r('oldest', 3)}, {b.r('middle', 3)}, {b.r('newest', 3)}, {b.r('weighted', 3, 'weighted / 1e6')} FROM x WHERE n = 1024""",
    ),
    "fe13_standardise": (
        standardise,
        f"""WITH {b.HOURLY}, s AS (SELECT *, CASE WHEN ts < TIMESTAMP '{b.TEST_START}' THEN 'train' ELSE 'test' END AS split FROM hourly),
        m AS (SELECT series_id, avg(y) AS mean, stddev_pop(y) AS std FROM s WHERE split = 'train' GROUP BY 1)
        SELECT series_id, ts, {b.r('y')}, split, {b.r('scaled', 6, '(y - mean) / std')}, {b.r('back', 6, 'y')} FROM s JOIN m USING (series_id)""",
    ),
    "fe14_seasonal_difference": (
        seasonal_difference,
        f"""WITH {b.HOURLY}, d AS (SELECT series_id, ts, y, y - lag(y, 24) OVER (PARTITION BY series_id ORDER BY ts) AS diff FROM hourly)
        SELECT series_id, ts, {b.r('y')}, {b.r('diff')} FROM d WHERE diff IS NOT NULL""",
    ),
    "fe15_feature_bounds": (
        feature_bounds,
        f"WITH {b.FEATURED} " + " UNION ALL ".join(
            f"SELECT series_id, '{c}' AS feature, {b.r('min', 6, f'min({c})::DOUBLE')}, {b.r('max', 6, f'max({c})::DOUBLE')}, {b.r('mean', 6, f'avg({c})')} "
            "FROM featured WHERE split = 'train' GROUP BY 1" for c in _FEATURES
        ),
    ),
    "fe16_recent_tail": (
        recent_tail,
        f"""WITH {b.DAILY}, t AS (SELECT * FROM daily WHERE ts < TIMESTAMP '{b.DAILY_TEST_START}'), m AS (SELECT series_id, max(ts) AS z FROM t GROUP BY 1)
        SELECT series_id, ts, {b.r('y', 2)} FROM t JOIN m USING (series_id) WHERE ts > z - INTERVAL 90 DAY""",
    ),
    "fc1_naive_forecasts": (naive_forecasts, f"WITH {b.NAIVE} SELECT series_id, model, horizon, ts, {b.r('y_true')}, {b.r('y_pred')} FROM naive"),
    "fc2_boosted_early_stopping": (boosted_early_stopping, None),
    "fc2_early_stopping_trees": (early_stopping_trees, None),
    "fc3_boosted_direct": (boosted_direct, None),
    "fc3_boosted_first_trees": (
        boosted_first_trees,
        f"WITH {b.FEATURED} SELECT series_id, model, horizon, ts, {b.r('y_true', 4)}, {b.r('y_pred', 4)} FROM {_first_trees('featured')}",
    ),
    "fc4_feature_importances": (feature_importances, None),
    "fc5_random_search": (random_search, None),
    "fc6_seasonal_ar_fit": (
        seasonal_ar_fit,
        f"WITH {_ar_sql(336)} SELECT series_id, n_fit, {', '.join(b.r(f'b_{t}', 4) for t in _TERMS)} FROM fit",
    ),
    "fc6_seasonal_ar_forecast": (
        seasonal_ar,
        f"""WITH {_ar_sql(2160)} SELECT series_id, 'seasonal_ar' AS model, 'h=1' AS horizon, ts, {b.r('y_true', 4, 'y')},
        {b.r('y_pred', 4, 'base + b_one + b_d1 * d1 + b_d2 * d2 + b_d3 * d3')} FROM terms JOIN fit USING (series_id) WHERE split = 'test'""",
    ),
    "fc6_long_autoregression": (
        long_autoregression,
        f"WITH {_FIRST} SELECT series_id, n_fit, {', '.join(b.r(f'b_{t}', 5) for t in _LONG_TERMS)} FROM fit1",
    ),
    "fc6_seasonal_arma_fit": (
        seasonal_arma_fit,
        f"WITH {_SECOND} SELECT series_id, n_fit, {', '.join(b.r(f'b_{t}', 5) for t in arma.MODEL_TERMS)} FROM fit2",
    ),
    "fc6_seasonal_arma_forecast": (
        seasonal_arma,
        f"""WITH RECURSIVE {_ARMA} SELECT series_id, 'seasonal_arma' AS model, 'h=1' AS horizon, ts, {b.r('y_true', 4, 'y')}, {b.r('y_pred', 4, 'y - e')}
        FROM walk JOIN steps USING (series_id, rn) WHERE ts >= TIMESTAMP '{b.TEST_START}'""",
    ),
    "snk5_reload_model": (reload_model, None),
    "fc7_forecast_at": (
        forecast_at,
        f"""WITH {b.NAIVE}, near AS (SELECT series_id, arg_min(ts, abs(date_diff('second', TIMESTAMP '2024-01-26 18:30:00', ts)) * 10 - (ts > TIMESTAMP '2024-01-26 18:30:00')::INT) AS ts FROM naive GROUP BY 1)
        SELECT series_id, model, horizon, ts, {b.r('actual', 6, 'y_true')}, {b.r('forecast', 6, 'y_pred')}, {b.r('error', 6, 'y_pred - y_true')} FROM naive JOIN near USING (series_id, ts)""",
    ),
    "fc7_forecast_requests": (
        forecast_requests,
        f"""WITH {b.FEATURED}, moved AS (SELECT series_id, ts, split, y, hour, dayofweek, {_DIRECT_COLUMNS} FROM featured WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
        direct AS (SELECT * FROM moved WHERE {' AND '.join(f'{c} IS NOT NULL' for c in b.HISTORY)}),
        made AS MATERIALIZED (SELECT * FROM {_first_trees('featured')} UNION ALL SELECT * FROM {_first_trees('direct', 'h=24')}),
        asked AS (SELECT event_id, event_type AS series_id, ts + INTERVAL 14 DAY AS requested FROM events),
        times AS (SELECT DISTINCT series_id, ts FROM made),
        low AS (SELECT a.*, t.ts AS low FROM asked a ASOF LEFT JOIN times t ON a.series_id = t.series_id AND a.requested >= t.ts),
        both_ AS (SELECT l.*, t.ts AS high FROM low l ASOF LEFT JOIN times t ON l.series_id = t.series_id AND l.requested <= t.ts),
        near AS (SELECT event_id, series_id, requested, CASE WHEN low IS NULL OR high - requested <= requested - low THEN high ELSE low END AS ts FROM both_)
        SELECT event_id, n.series_id, requested, n.ts, model, horizon, {b.r('actual', 4, 'y_true')}, {b.r('forecast', 4, 'y_pred')}, {b.r('error', 4, 'y_pred - y_true')}
        FROM near n LEFT JOIN made m ON n.series_id = m.series_id AND n.ts = m.ts""",
    ),
    "fc7_forecast_context": (
        forecast_context,
        f"WITH {b.HOURLY} SELECT series_id, ts, {b.r('y')} FROM hourly WHERE ts BETWEEN TIMESTAMP '2024-01-24 19:00:00' AND TIMESTAMP '2024-01-27 01:00:00'",
    ),
    **{
        f"mt{i}_{n}": (_one(n, e), f"WITH {b.SALES} SELECT series_id, model, {b.r(n, 4, _METRIC_SQL[n])} FROM sales GROUP BY 1, 2")
        for i, (n, e) in enumerate((("mae", mt.mae), ("rmse", mt.rmse), ("mape", mt.mape), ("smape", mt.smape)), 1)
    },
    "mt5_seasonal_naive_scale": (
        seasonal_naive_scale,
        f"""WITH {b.DAILY}, d AS (SELECT series_id, y - lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts) AS d FROM daily WHERE ts < TIMESTAMP '{b.DAILY_TEST_START}')
        SELECT series_id, {b.r('scale', 4, 'avg(abs(d))')} FROM d GROUP BY 1""",
    ),
    "mt5_scale_after_loss": (
        scale_after_loss,
        f"""WITH {b.HOURLY}, kept AS (SELECT series_id, ts, y FROM hourly WHERE y IS NOT NULL AND day(ts) * 24 + hour(ts) <> 500),
        d AS (SELECT series_id, y - lag(y, 24) OVER (PARTITION BY series_id ORDER BY ts) AS d FROM kept)
        SELECT series_id, {b.r('scale', 6, 'avg(abs(d))')} FROM d GROUP BY 1""",
    ),
    "mt6_mase": (
        mase,
        f"WITH {b.NAIVE}, {_SCALE} SELECT series_id, model, {b.r('mase', 6, f'avg({_ERR}) / nullif(any_value(scale), 0)')} FROM naive JOIN scale USING (series_id) GROUP BY 1, 2",
    ),
    "mt7_evaluate": (
        evaluate,
        f"WITH {b.SALES} SELECT series_id, model, horizon, count(*) AS n, 0::BIGINT AS n_null, "
        + ", ".join(b.r(n, 4, e) for n, e in _METRIC_SQL.items()) + f", {b.r('mase', 4, f'avg({_ERR}) / 30000')} FROM sales GROUP BY 1, 2, 3",
    ),
    "mt8_leaderboard": (
        leaderboard,
        f"WITH {b.NAIVE}, {_SCALE}, board AS (SELECT series_id, model, horizon, count(*) AS n, 0::BIGINT AS n_null, "
        + ", ".join(f"{e} AS {n}" for n, e in _METRIC_SQL.items()) + f", avg({_ERR}) / any_value(scale) AS mase FROM naive JOIN scale USING (series_id) GROUP BY 1, 2, 3) "
        + "SELECT series_id, model, horizon, n, n_null, " + ", ".join(b.r(m) for m in mt.METRICS)
        + ", CAST(row_number() OVER (PARTITION BY series_id, horizon ORDER BY mae, model) AS INTEGER) AS rank FROM board",
    ),
    "mt9_error_breakdown": (error_breakdown, f"WITH {b.NAIVE} SELECT series_id, model, hour(ts) AS hour, {b.r('mae', 6, f'avg({_ERR})')} FROM naive GROUP BY 1, 2, 3"),
    "mt9_error_breakdowns": (error_breakdowns, f"WITH {b.SALES} {_BREAK}"),
    "mt9_error_side_by_side": (
        error_side_by_side,
        f"WITH {b.SALES} SELECT series_id, month(ts) AS month, " + ", ".join(b.r(m, 4, f"avg({_ERR}) FILTER (WHERE model = '{m}')") for m in ("A", "N"))
        + " FROM sales WHERE model IN ('A', 'N') GROUP BY 1, 2",
    ),
    "mt10_worst_levels": (worst_levels, f"WITH {b.SALES} SELECT model, month(ts) AS month, {b.r('mae', 4, f'avg({_ERR})')} FROM sales GROUP BY 1, 2 ORDER BY avg({_ERR}) DESC LIMIT 4"),
    "mt10_pick_levels": (pick_levels, f"WITH {b.SALES} SELECT series_id, model, month(ts) AS month, {b.r('mae', 4, f'avg({_ERR})')} FROM sales WHERE month(ts) IN (1, 8) GROUP BY 1, 2, 3"),
    "mt11_residuals": (
        residuals,
        f"""WITH {b.SALES}, e AS (SELECT series_id, model, y_true - y_pred AS e FROM sales)
        SELECT series_id, model, count(e) AS n, {b.r('mean', 4, 'avg(e)')}, {b.r('low', 4, 'min(e)')}, {b.r('high', 4, 'max(e)')} FROM e GROUP BY 1, 2""",
    ),
    "mt12_cv_summary": (cv_summary, f"WITH {_SUMMARY} SELECT series_id, model, n_folds, {b.r('cv_mae_mean')}, {b.r('cv_mae_std')} FROM summary"),
    "mt13_cv_winner": (cv_winner, f"WITH {_SUMMARY} SELECT series_id, arg_min(model, cv_mae_mean) AS winner, {b.r('cv_mae', 6, 'min(cv_mae_mean)')} FROM summary GROUP BY 1"),
    "cv1_expanding_folds": (
        expanding_folds,
        f"""WITH {_DLAGS} SELECT series_id, CAST(fold AS INTEGER) AS fold, CASE WHEN pos >= lo THEN 'val' ELSE 'train' END AS role,
        count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM folds WHERE pos < hi GROUP BY 1, 2, 3""",
    ),
    "cv2_cv_naive": (cv_naive, f"WITH {_CV} SELECT series_id, model, fold, {b.r('val_mae')} FROM cv"),
    "cv3_cv_boosted": (cv_boosted, None),
    "cv4_cv_seasonal_ar": (cv_seasonal_ar, None),
}
