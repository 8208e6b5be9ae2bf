"""Tail probabilities of the test statistics.

The normal quantile runs per row, so it is a Spark expression. The others see a handful of
numbers per series and are small vectorised helpers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

# AS241 (Wichura 1988) coefficients of the normal quantile, lowest power first.
CENTRE_NUM = [
    3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
    45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727,
]
CENTRE_DEN = [
    1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
    21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610,
]
MIDDLE_NUM = [
    1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
    1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4,
]
MIDDLE_DEN = [
    1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
    0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9,
]
TAIL_NUM = [
    6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
    0.0265321895265761230930, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7,
]
TAIL_DEN = [
    1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15,
]

# Response surface of the unit-root t statistic with a constant (MacKinnon 1994),
# lowest power first, for the left part, the right part, and their limits.
ADF_LEFT = [2.1659, 1.4412, 0.038269]
ADF_RIGHT = [1.7339, 0.93202, -0.12745, -0.010368]
ADF_SWITCH, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74

# Upper-tail critical values of the level-stationarity statistic (KPSS 1992).
KPSS_CRITICAL = [0.347, 0.463, 0.574, 0.739]
KPSS_LEVELS = [0.10, 0.05, 0.025, 0.01]


def _ratio(x: Column, top: Sequence[float], bottom: Sequence[float]) -> Column:
    def horner(coefficients: Sequence[float]) -> Column:
        value = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            value = value * x + F.lit(c)
        return value

    return horner(top) / horner(bottom)


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function for 0 < p < 1."""
    q = p - 0.5
    root = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    outer = F.when(root <= 5, _ratio(root - 1.6, MIDDLE_NUM, MIDDLE_DEN)).otherwise(_ratio(root - 5.0, TAIL_NUM, TAIL_DEN))
    centre = q * _ratio(F.lit(0.180625) - q * q, CENTRE_NUM, CENTRE_DEN)
    return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * outer)


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while term > total * 1e-17:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(DoubleType())
def chi2_tail(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution."""
    pairs = zip(statistic, freedom)
    return pd.Series([None if pd.isna(x) else gamma_upper(k / 2, x / 2) for x, k in pairs], dtype="float64")


def adf_pvalue(t: float) -> float:
    """Approximate p-value of the unit-root statistic (constant, one series)."""
    if t > ADF_MAX:
        return 1.0
    if t < ADF_MIN:
        return 0.0
    surface = ADF_LEFT if t <= ADF_SWITCH else ADF_RIGHT
    z = sum(c * t**i for i, c in enumerate(surface))
    return NormalDist().cdf(z) if z > -5 else 0.5 * math.erfc(-z / math.sqrt(2))


def kpss_pvalue(statistic: Column) -> Column:
    """Interpolated p-value, clamped to the tabulated range [0.01, 0.10]."""
    value = F.when(statistic <= KPSS_CRITICAL[0], F.lit(KPSS_LEVELS[0]))
    points = list(zip(KPSS_CRITICAL, KPSS_LEVELS))
    for (x0, p0), (x1, p1) in zip(points, points[1:]):
        value = value.when(statistic <= x1, F.lit(p0) + (statistic - x0) * ((p1 - p0) / (x1 - x0)))
    return value.when(statistic.isNotNull(), F.lit(KPSS_LEVELS[-1]))


def cross_sums(own: np.ndarray, extended: np.ndarray, lags: int) -> np.ndarray:
    """``sum_t own[t] * extended[t + lags - k]`` for k = 0..lags; ``extended`` starts ``lags`` earlier."""
    if lags <= 256:
        return np.correlate(extended, own, "valid")[::-1]
    size = 1 << (len(extended) - 1).bit_length()
    product = np.fft.irfft(np.fft.rfft(extended, size) * np.conj(np.fft.rfft(own, size)), size)
    return product[: lags + 1][::-1]
