"""Scoring night by night from a tail of each series instead of its history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys
from wattgrid.operators import features as ft

# The longest lag, the horizon, and one row more.
TAIL = max(ft.LAGS) + 24 + 1
_AT = "at"


def tail_state(
    df: DataFrame, length: int = TAIL, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts", step: int = HOUR
) -> DataFrame:
    """``(keys, tail)``: the last ``length`` grid points of every series in one array, in order of time.

    Older rows are left out before anything is collected. A repeated timestamp keeps its largest value; rows without
    key or timestamp are left out, NULL values stay in.
    """
    names = as_keys(keys)
    slim = df.select(*names, ts, target).dropna(subset=[*names, ts])
    recent = ft.recent_tail(slim, length, names, ts, step).groupBy(*names, ts).agg(F.max(target).alias(target))
    return _collected(recent, names, ts, target)


def _collected(rows: DataFrame, names: list[str], ts: str, target: str) -> DataFrame:
    row = F.struct(F.col(ts).alias(_AT), F.col(target).alias("value"))
    return rows.groupBy(*names).agg(F.sort_array(F.collect_list(row)).alias("tail"))


def tail_rows(state: DataFrame, target: str = "y", keys: str | Sequence[str] = "series_id", ts: str = "ts") -> DataFrame:
    """The rows of a state: ``(keys, ts, target)``."""
    unfolded = state.select(*as_keys(keys), F.inline("tail"))
    return unfolded.withColumnsRenamed({_AT: ts, "value": target})


def merge_tails(
    older: DataFrame, newer: DataFrame, length: int = TAIL, target: str = "y", keys: str | Sequence[str] = "series_id",
    ts: str = "ts", step: int = HOUR,
) -> DataFrame:
    """The state of both parts together. Where both hold a timestamp, ``newer`` decides. Merging is associative."""
    names = as_keys(keys)
    parts = [tail_rows(s, target, names, ts).withColumn("__part", F.lit(i)) for i, s in enumerate((older, newer))]
    rows = parts[0].unionByName(parts[1]).groupBy(*names, ts).agg(F.max_by(F.struct(target), "__part").alias("__v"))
    kept = ft.recent_tail(rows.select(*names, ts, f"__v.{target}"), length, names, ts, step)
    return _collected(kept, names, ts, target)


def night_matrix(
    state: DataFrame,
    day: DataFrame,
    horizon: int = 24,
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    **feature_options,
) -> DataFrame:
    """The rows that ``features.direct_matrix`` has for the timestamps of ``day``, from the state before that day.

    Reads the tail and the day only. Equal to the matrix over the whole history as long as the tail holds ``horizon``
    rows with all features: ``TAIL`` holds one more, and every row that a NULL takes needs a longer one.
    ``feature_options`` go to ``features.build_features``.
    """
    names = as_keys(keys)
    fresh = day.select(*names, ts, target)
    known = tail_rows(state, target, names, ts)
    both = known.join(fresh, [*names, ts], "left_anti").unionByName(fresh)
    made = ft.build_features(both, target, keys=names, ts=ts, step=step, **feature_options)
    ready = ft.drop_warmup(made).withColumn("split", F.lit("test"))
    matrix = ft.direct_matrix(ready, horizon, target, names, ts, step)
    return matrix.join(fresh.select(*names, ts), [*names, ts], "left_semi")
