"""The hourly roll-up over a stream of meter records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys
from wattgrid.operators.cleaning import METER_ROLLUP


def rollup_stream(
    stream: DataFrame,
    spec: Mapping[str, tuple[str, float]] = METER_ROLLUP,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    lateness: str = "2 hours",
) -> DataFrame:
    """Aggregate each closed bucket once; records later than ``lateness`` are ignored.

    Event time must be TIMESTAMP (a watermark rejects TIMESTAMP_NTZ), so the session runs in UTC.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    bucket = F.window(ts, f"{step} seconds")
    made = []
    for c, (how, scale) in spec.items():
        value = F.col(c).cast("double")
        total = F.coalesce(F.sum(value), F.lit(0.0)) if how == "sum" else F.avg(value)
        made.append((total * scale).alias(c))
    rolled = timed.groupBy(*as_keys(keys), bucket.alias("__w")).agg(*made)
    return rolled.select(*as_keys(keys), F.col("__w.start").cast("timestamp_ntz").alias(ts), *spec)
