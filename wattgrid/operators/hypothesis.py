"""Seasonality, autocorrelation and stationarity tests for many series of any length.

Long sums run distributed: by value ranges for ranks, by halo buckets for lagged products. What
reaches a per-series formula is one number per lag.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattgrid.functions.distributions import adf_pvalue, chi2_tail, cross_sums, kpss_pvalue
from wattgrid.functions.timeaxis import HOUR, as_keys, calendar_part
from wattgrid.operators.features import seasonal_difference
from wattgrid.plans.buckets import BUCKET, attach, bucket_rows, row_positions, running_before, with_halo
from wattgrid.plans.ranks import cumulative

ALPHA = 0.05
SEASONAL_PERIOD = 24
LJUNG_BOX_LAGS = [24, 168, 720]
# Fixed value: 97.5 % point of the standard normal distribution.
Z975 = 1.959963984540054
ARRAY_SALTS = 64


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


# --- Kruskal-Wallis -------------------------------------------------------------------------


def kruskal_by(
    df: DataFrame, factor: str = "hour", target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts"
) -> DataFrame:
    """Do the calendar levels share one distribution? ``(keys, factor, statistic, pvalue, significant)``."""
    names = as_keys(keys)
    level = calendar_part(factor, ts).alias("__level")
    counts = (
        df.where(F.col(target).isNotNull())
        .groupBy(*names, F.col(target).cast("double").alias("__v"), level)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = cumulative(counts, names, "__v")
    rank = F.col("upto") - (F.col("ties") - 1) / 2
    n, ties = F.col("n").cast("double"), F.col("ties").cast("double")
    groups = ranked.groupBy(*names, "__level").agg(
        F.sum(n * rank).alias("__r"), F.sum(n).alias("__n"), F.sum(n * (ties * ties - 1)).alias("__t")
    )
    # One row per level: squares of distances from the middle rank lose no digits of a small statistic.
    sized = groups.withColumn("N", F.sum("__n").over(Window.partitionBy(*names)))
    apart = F.col("__r") / F.col("__n") - (F.col("N") + 1) / 2
    totals = sized.groupBy(*names, "N").agg(
        F.sum(F.col("__n") * apart * apart).alias("S"), F.sum("__t").alias("T"), F.count(F.lit(1)).alias("k")
    )
    N = F.col("N")
    # NULL without a spread of ranks: one value, or all values equal.
    tied = F.lit(1.0) - F.col("T") / F.nullif(N * N * N - N, F.lit(0.0))
    h = F.lit(12.0) / (N * (N + 1)) * F.col("S") / F.nullif(tied, F.lit(0.0))
    tested = totals.select(*names, F.lit(factor).alias("factor"), h.alias("statistic"), (F.col("k") - 1).alias("__df"))
    with_p = tested.withColumn("pvalue", chi2_tail("statistic", "__df")).drop("__df")
    return with_p.withColumn("significant", F.col("pvalue") < ALPHA)


# --- lagged products ------------------------------------------------------------------------


def _standing(df: DataFrame, target: str, names: list[str], ts: str, step: int) -> DataFrame:
    """Non-missing values with their position, the series length and the centred value ``e``."""
    present = df.where(F.col(target).isNotNull()).select(*names, ts, F.col(target).cast("double").alias("__y"))
    moments = present.groupBy(*names).agg(F.avg("__y").alias("__m"), F.stddev_pop("__y").alias("__s"))
    placed = row_positions(present, keys=names, ts=ts, step=step, total="n")
    return attach(placed, moments, names).withColumn("e", F.col("__y") - F.col("__m"))


def _dense(pdf: pd.DataFrame, width: int, before: int, column: str) -> tuple[np.ndarray, int]:
    """Bucket values on their positions, zero where the series has none; first own position."""
    start = int(pdf[BUCKET].iloc[0]) * width - before
    values = np.zeros(width + before)
    values[pdf["pos"].to_numpy() - start] = pdf[column].to_numpy()
    return values, start + before


def _product_kernel(names: list[str], width: int, reach: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        values, first = _dense(pdf, width, reach, "e")
        count = int((pdf["pos"] >= first).sum())
        if not count:
            return pd.DataFrame()
        own = values[reach : reach + count]
        sums = np.cumsum(own)
        row = {n: pdf[n].iloc[0] for n in names}
        row |= {
            BUCKET: int(pdf[BUCKET].iloc[0]), "n": int(pdf["n"].iloc[0]), "size": count,
            "total": float(sums[-1]), "s1": float(sums.sum()), "s2": float((sums * sums).sum()),
            "cross": cross_sums(own, values[: reach + count], reach),
        }
        return pd.DataFrame([row])

    return kernel


def bucket_products(
    df: DataFrame,
    reach: int,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
) -> DataFrame:
    """Per bucket: lagged products up to ``reach``, and sums of the running sum (for KPSS).

    Each task sees one bucket and ``reach`` rows before it, as arrays.
    """
    names = as_keys(keys)
    width = bucket_rows(reach, rows)
    standing = _standing(df, target, names, ts, step)
    spread = with_halo(standing.select(*names, "pos", "n", "e"), "pos", before=reach, rows=width)
    schema = (
        f"{_fields(spread, names)}, {BUCKET} bigint, n bigint, size bigint, total double, s1 double, s2 double, cross array<double>"
    )
    return spread.groupBy(*names, BUCKET).applyInPandas(_product_kernel(names, width, reach), schema)


def autocovariance_sums(products: DataFrame, keys: str | Sequence[str] = "series_id") -> DataFrame:
    """``(keys, n, lag, c)`` with ``c = sum_t e_t e_{t-lag}``."""
    names = as_keys(keys)
    exploded = products.select(*names, "n", F.posexplode("cross").alias("lag", "c"))
    return exploded.groupBy(*names, "n", "lag").agg(F.sum("c").alias("c")).where(F.col("lag") < F.col("n"))


def acf(
    df: DataFrame,
    lags: int = 168,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
) -> DataFrame:
    """Autocorrelation at lags 0..``lags`` with the half width of its Bartlett band."""
    names = as_keys(keys)
    sums = autocovariance_sums(bucket_products(df, lags, target, names, ts, step, rows), names)
    series = Window.partitionBy(*names)
    # NULL for a constant series, which has no variance.
    r = F.col("c") / F.nullif(F.max(F.when(F.col("lag") == 0, F.col("c"))).over(series), F.lit(0.0))
    earlier = series.orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.sqrt((inner * 2 + 1) / F.col("n")) * Z975)
    return sums.withColumn("acf", r).withColumn("band", band).select(*names, "n", "lag", "acf", "band")


def _durbin_levinson(r: np.ndarray) -> np.ndarray:
    out = np.ones(len(r))
    phi = np.zeros(0)
    spread = 1.0
    for k in range(1, len(r)):
        last = (r[k] - phi @ r[k - 1 : 0 : -1]) / spread if k > 1 else r[1]
        phi = np.append(phi - last * phi[::-1], last)
        spread *= 1 - last * last
        out[k] = last
    return out


def pacf(
    df: DataFrame,
    lags: int = 168,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Partial autocorrelation (Yule-Walker, biased) from the ``lags + 1`` autocorrelations."""
    names = as_keys(keys)
    found = acf(df, lags, target, names, ts, step)

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("lag")
        known = ordered["acf"].notna().all()
        ordered["pacf"] = _durbin_levinson(ordered["acf"].to_numpy()) if known else np.nan
        return ordered[[*names, "lag", "pacf"]]

    schema = f"{_fields(found, names)}, lag int, pacf double"
    return found.groupBy(*names).applyInPandas(kernel, schema)


def ljung_box(
    df: DataFrame,
    lags: Sequence[int] = LJUNG_BOX_LAGS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Portmanteau statistic and p-value at the requested lags."""
    names = as_keys(keys)
    found = acf(df, max(lags), target, names, ts, step).where(F.col("lag") > 0)
    n = F.col("n").cast("double")
    term = F.col("acf") * F.col("acf") / (n - F.col("lag"))
    upto = Window.partitionBy(*names).orderBy("lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    q = found.withColumn("statistic", n * (n + 2) * F.sum(term).over(upto)).where(F.col("lag").isin(list(lags)))
    return q.select(*names, "lag", "statistic", chi2_tail("statistic", "lag").alias("pvalue"))


# --- unit root ------------------------------------------------------------------------------


def adf_max_lag(n: Column | int) -> Column | int:
    """Largest lag order tried: ceil(12 (n/100)^(1/4)), at most n div 2 - 2."""
    if isinstance(n, int):
        return min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    return F.least(F.ceil(F.pow(n / 100, F.lit(0.25)) * 12), F.floor(n / 2) - 2).cast("int")


def _regressors(z: np.ndarray, first: int, last: int, order: int) -> np.ndarray:
    """Rows ``[1, z_{t-1}, dz_{t-1}, ..., dz_{t-order}, dz_t]`` for array positions first..last."""
    dz = np.diff(z, prepend=z[0])
    t = np.arange(first, last + 1)
    columns = [np.ones(len(t)), z[t - 1]]
    columns += [dz[t - k] for k in range(1, order + 1)]
    columns.append(dz[t])
    return np.column_stack(columns)


def _gram_kernel(names: list[str], width: int, reach: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        order = adf_max_lag(n)
        if order < 0:
            return pd.DataFrame()
        values, first = _dense(pdf, width, reach, "z")
        origin = first - reach
        low, high = max(first, order + 1), min(first + width, n) - 1
        if high < low:
            return pd.DataFrame()
        x = _regressors(values, low - origin, high - origin, order)
        row = {name: pdf[name].iloc[0] for name in names}
        row |= {BUCKET: int(pdf[BUCKET].iloc[0]), "n": n, "gram": (x.T @ x)[np.triu_indices(x.shape[1])]}
        return pd.DataFrame([row])

    return kernel


def _adf_statistic(n: int, gram: np.ndarray, head: np.ndarray) -> tuple[float, int]:
    """Lag order by AIC on the common sample, then the t statistic on that order's own sample. ``gram`` is
    the upper triangle, row by row."""
    order = adf_max_lag(n)
    full = np.zeros((order + 3, order + 3))
    full[np.triu_indices(order + 3)] = gram
    full = np.triu(full) + np.triu(full, 1).T
    common = n - 1 - order
    # One triangular sweep eliminates the regressors in order: what it has explained up to a regressor is
    # what the nested regression of that order explains.
    root = np.linalg.cholesky(full[:-1, :-1])
    explained = np.cumsum(np.linalg.solve(root, full[:-1, -1]) ** 2)
    best = (math.inf, 0)
    for p in range(order + 1):
        ssr = full[-1, -1] - explained[p + 1]
        if ssr > 0:
            best = min(best, (common * math.log(ssr / common) + 2 * (p + 2), p))
    p = best[1]
    keep = [*range(p + 2), order + 2]
    own = full[np.ix_(keep, keep)]
    if p < order:
        extra = _regressors(head, p + 1, order, p)
        own = own + extra.T @ extra
    xx, xy = own[:-1, :-1], own[:-1, -1]
    inverse = np.linalg.inv(xx)
    beta = inverse @ xy
    freedom = n - 1 - p - (p + 2)
    variance = (own[-1, -1] - xy @ beta) / freedom
    return float(beta[1] / math.sqrt(variance * inverse[1, 1])), p


def _summed_arrays(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Arrays of equal length added up per key, in two steps, so that a long series is no single task's."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[names].head(1).reset_index(drop=True)
        out[column] = [np.sum(np.stack(pdf[column].to_list()), axis=0)]
        return out

    schema = f"{_fields(df, names)}, {column} array<double>"
    salted = df.select(*names, column, F.pmod(F.col(BUCKET), F.lit(ARRAY_SALTS)).alias("__salt"))
    once = salted.groupBy(*names, "__salt").applyInPandas(add, schema)
    return once.groupBy(*names).applyInPandas(add, schema)


def adf(
    df: DataFrame,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
) -> DataFrame:
    """Augmented Dickey-Fuller test with constant, lag order by AIC.

    One pass builds the cross-product matrix of all candidate regressors; every lag order is a
    leading block of it. The longest series, counted first, decides how many lags the pass carries.
    Series too short for any order, and constant ones, have NULL results.
    """
    names = as_keys(keys)
    reach = max(adf_max_lag(_longest(df, target, names)), 0) + 2
    width = bucket_rows(reach, rows)
    z = F.when(F.col("__s") > 0, F.col("e") / F.col("__s")).otherwise(F.lit(0.0))
    standing = _standing(df, target, names, ts, step).withColumn("z", z).select(*names, "pos", "n", "z")
    spread = with_halo(standing, "pos", before=reach, rows=width)
    partial = spread.groupBy(*names, BUCKET).applyInPandas(
        _gram_kernel(names, width, reach), f"{_fields(spread, names)}, {BUCKET} bigint, n bigint, gram array<double>"
    )
    grams = _summed_arrays(partial, "gram", [*names, "n"])
    heads = (
        standing.where(F.col("pos") <= adf_max_lag(F.col("n")))
        .groupBy(*names)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "z"))).alias("head"))
    )
    ready = grams.join(heads, names).select(*names, "n", "gram", F.col("head.z").alias("head"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for n, gram, head in zip(batch["n"], batch["gram"], batch["head"]):
                try:
                    statistic, order = _adf_statistic(int(n), np.asarray(gram), np.asarray(head))
                    out.append((statistic, adf_pvalue(statistic), order))
                except (np.linalg.LinAlgError, ZeroDivisionError, ValueError):
                    out.append((None, None, None))
            found = pd.DataFrame(out, columns=["adf_stat", "adf_pvalue", "adf_lags"])
            yield pd.concat([batch[names].reset_index(drop=True), found.astype({"adf_lags": "Int64"})], axis=1)

    tested = ready.mapInPandas(solve, f"{_fields(ready, names)}, adf_stat double, adf_pvalue double, adf_lags bigint")
    return _every_series(df, tested, names)


def _every_series(df: DataFrame, tested: DataFrame, names: list[str]) -> DataFrame:
    """Series that are too short for a test keep a row with NULLs."""
    return df.select(*names).distinct().join(tested, names, "left")


def _longest(df: DataFrame, target: str, names: list[str]) -> int:
    """Number of values of the longest series."""
    return df.groupBy(*names).agg(F.count(target).alias("n")).agg(F.max("n")).first()[0] or 0


def _weighted(upto: Column, term: Callable[[Column, Column], Column]) -> Column:
    """Sum of ``term(lag, autocovariance sum)`` over lags 1..``upto``."""
    indices = F.when(upto >= 1, F.sequence(F.lit(1), upto)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(indices, F.lit(0.0), lambda acc, i: acc + term(i, F.element_at("__g", i + 1)))


def _kpss_sized(products: DataFrame, names: list[str]) -> DataFrame:
    """``(keys, n, __sq, __g, kpss_lags)``: squared running sums, autocovariance sums and bandwidth."""
    carry = running_before("total", names)
    squares = products.select(
        *names, "n",
        (F.col("size") * carry * carry + carry * 2 * F.col("s1") + F.col("s2")).alias("__sq"),
    ).groupBy(*names, "n").agg(F.sum("__sq").alias("__sq"))
    by_lag = autocovariance_sums(products, names).groupBy(*names, "n").agg(
        F.sort_array(F.collect_list(F.struct("lag", "c"))).alias("__c")
    )
    n = F.col("n").cast("double")
    pilot = F.least(F.floor(F.pow(n, F.lit(2 / 9)) + 1e-12), n - 1).cast("int")
    joined = squares.join(by_lag, [*names, "n"]).withColumn("__g", F.col("__c.c"))
    s0 = F.element_at("__g", 1) / n + _weighted(pilot, lambda i, c: c * 2 / n)
    s1 = _weighted(pilot, lambda i, c: i * c * 2 / n)
    ratio = s1 / F.nullif(s0, F.lit(0.0))
    gamma = F.pow(ratio * ratio, F.lit(1 / 3)) * 1.1447
    # A constant series has no bandwidth; it must not set the number of lags for the others.
    bandwidth = F.when(ratio.isNotNull(), F.least(F.floor(gamma * F.pow(n, F.lit(1 / 3))), n - 1)).cast("int")
    return joined.select(*names, "n", "__sq", "__g", bandwidth.alias("kpss_lags"))


def kpss(
    df: DataFrame,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    rows: int | None = None,
) -> DataFrame:
    """KPSS level-stationarity test with the automatic bandwidth of Hobijn et al. (1998).

    The squared running sums of a bucket follow from three numbers of the bucket and the total of
    the earlier ones, so running sums never leave their bucket. A first pass over the few lags of the
    pilot estimate finds the bandwidths, and the second carries as many lags as the largest of them.
    Constant series have NULL results.
    """
    names = as_keys(keys)
    pilot_reach = int(max(_longest(df, target, names), 1) ** (2 / 9) + 1e-12) + 1
    first = _kpss_sized(bucket_products(df, pilot_reach, target, names, ts, step, rows), names)
    reach = max(first.agg(F.max("kpss_lags")).first()[0] or 0, pilot_reach)
    products = bucket_products(df, reach, target, names, ts, step, rows)
    sized = _kpss_sized(products, names)
    n = F.col("n").cast("double")
    zero = F.element_at("__g", 1)
    longrun = (zero + _weighted(F.col("kpss_lags"), lambda i, c: c * 2 * (F.lit(1.0) - i / (F.col("kpss_lags") + 1.0)))) / n
    statistic = F.col("__sq") / (n * n) / F.nullif(longrun, F.lit(0.0))
    tested = sized.withColumn("kpss_stat", statistic)
    found = tested.select(
        *names, "kpss_stat", kpss_pvalue(F.col("kpss_stat")).alias("kpss_pvalue"), F.col("kpss_lags").cast("bigint").alias("kpss_lags")
    )
    return _every_series(df, found, names)


def verdict(tests: DataFrame) -> DataFrame:
    """Joint reading of both tests; they have opposite null hypotheses."""
    a, k = F.col("adf_pvalue") < ALPHA, F.col("kpss_pvalue") >= ALPHA
    joint = (
        F.when(a.isNull() | k.isNull(), F.lit(None).cast("string"))  # too short or constant: not tested
        .when(a & k, "stationary").when(~a & ~k, "non-stationary").otherwise("inconclusive")
    )
    return tests.withColumn("adf_stationary", a).withColumn("kpss_stationary", k).withColumn("verdict", joint)


def stationarity(
    df: DataFrame,
    label: str = "raw",
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Paired ADF and KPSS tests with their verdict, one row per series."""
    names = as_keys(keys)
    both = adf(df, target, names, ts, step).join(kpss(df, target, names, ts, step), names)
    columns = ["adf_stat", "adf_pvalue", "kpss_stat", "kpss_pvalue", "adf_stationary", "kpss_stationary", "verdict"]
    return verdict(both).select(*names, F.lit(label).alias("label"), *columns)


def labelled_pair(
    df: DataFrame,
    period: int = SEASONAL_PERIOD,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """The raw series and its seasonal difference, stacked under a ``label``."""
    names = as_keys(keys)
    raw = df.select(*names, ts, F.col(target).cast("double").alias("y"))
    moved = seasonal_difference(raw, period, "y", "__d", names, ts, step)
    differenced = moved.select(*names, F.lit(f"seasonal_diff_{period}").alias("label"), ts, F.col("__d").alias("y"))
    return raw.select(*names, F.lit("raw").alias("label"), ts, "y").unionByName(differenced)


def stationarity_raw_and_differenced(
    df: DataFrame,
    period: int = SEASONAL_PERIOD,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """Both tests on the raw series and its seasonal difference, two rows per series.

    The label is part of the key, so both versions go through one pass per test.
    """
    names = [*as_keys(keys), "label"]
    both = labelled_pair(df, period, target, keys, ts, step)
    tested = adf(both, "y", names, ts, step).join(kpss(both, "y", names, ts, step), names)
    columns = ["adf_stat", "adf_pvalue", "kpss_stat", "kpss_pvalue", "adf_stationary", "kpss_stationary", "verdict"]
    return verdict(tested).select(*names, *columns)


def summarize(
    df: DataFrame,
    period: int = SEASONAL_PERIOD,
    ljung_lags: Sequence[int] = LJUNG_BOX_LAGS,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
) -> DataFrame:
    """All tests of a series as one nested document."""
    names = as_keys(keys)
    counted = df.groupBy(*names).agg(F.count(target).alias("n_obs"))
    kruskal = None
    for factor in ("hour", "day_of_week"):
        found = kruskal_by(df, factor, target, names, ts)
        packed = found.select(*names, F.struct("factor", "statistic", "pvalue", "significant").alias(f"__{factor}"))
        kruskal = packed if kruskal is None else kruskal.join(packed, names, "full")
    tests = stationarity_raw_and_differenced(df, period, target, names, ts, step)
    inner = F.struct(*[c for c in tests.columns if c not in names])
    pairs = tests.groupBy(*names).agg(
        F.first(F.when(F.col("label") == "raw", inner), ignorenulls=True).alias("__raw"),
        F.first(F.when(F.col("label") != "raw", inner), ignorenulls=True).alias("__diff"),
    )
    portmanteau = ljung_box(df, ljung_lags, target, names, ts, step).groupBy(*names).agg(
        F.sort_array(F.collect_list(F.struct("lag", "statistic", "pvalue"))).alias("__lb")
    )
    joined = counted.join(kruskal, names, "left").join(pairs, names, "left").join(portmanteau, names, "left")
    return joined.select(
        *names,
        F.lit(target).alias("target"),
        "n_obs",
        F.lit(period).alias("seasonal_period"),
        F.struct(F.col("__hour").alias("hour"), F.col("__day_of_week").alias("day_of_week")).alias("kruskal"),
        F.struct(F.col("__raw").alias("raw"), F.col("__diff").alias("seasonal_diff")).alias("stationarity"),
        F.struct(F.array(*[F.lit(k) for k in ljung_lags]).alias("lags"), F.col("__lb").alias("results")).alias("ljung_box"),
    )


def headline_metrics(summary: DataFrame, keys: str | Sequence[str] = "series_id") -> DataFrame:
    """The document's numbers as long rows ``(keys, metric, value)``, for expectation checks."""
    names = as_keys(keys)
    fixed = {
        "kruskal_hour": "kruskal.hour.statistic",
        "kruskal_day_of_week": "kruskal.day_of_week.statistic",
        "raw_adf_pvalue": "stationarity.raw.adf_pvalue",
        "raw_kpss_pvalue": "stationarity.raw.kpss_pvalue",
        "diff_adf_pvalue": "stationarity.seasonal_diff.adf_pvalue",
        "diff_kpss_pvalue": "stationarity.seasonal_diff.kpss_pvalue",
    }
    scalars = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(p).alias("value")) for n, p in fixed.items()])
    tests = F.transform(
        "ljung_box.results",
        lambda r: F.struct(F.concat(F.lit("ljung_box_"), r["lag"].cast("string")).alias("metric"), r["statistic"].alias("value")),
    )
    return summary.select(*names, F.inline(F.concat(scalars, F.coalesce(tests, F.array().cast("array<struct<metric:string,value:double>>")))))
