"""Retraining alerts over a stream of predictions, equal to ``monitor.retrain_alerts``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wattgrid.functions.timeaxis import DAY, as_keys

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_PENDING = "ms bigint, err double, scale double, fitted bigint"
_STATE = "ring array<double>, run bigint, since bigint, fitted bigint, due bigint, wake bigint"


class _Alerts(StatefulProcessor):
    """One series and model. Rows wait until the watermark has passed them, then they are taken in
    the order of time: a ring of the last errors, the length and start of the current run of
    breaches, the newest fit and the time at which it is too old."""

    def __init__(self, columns: list[str], window: int, limit: float, hold: int, max_age: int):
        self._alert = Row(*columns)
        self._window, self._limit, self._hold, self._max_age = window, limit, hold, max_age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pending = handle.getListState("pending", _PENDING)
        self._held = handle.getValueState("held", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        earliest = None
        for r in rows:
            self._pending.appendValue((r["__ms"], r["__err"], r["scale"], r["__fitted"]))
            earliest = r["__ms"] if earliest is None else min(earliest, r["__ms"])
        state = self._load()
        if earliest is not None and (state["wake"] is None or earliest < state["wake"]):
            self._wake(state, earliest)
            self._store(state)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = timerValues.getCurrentWatermarkInMs()
        ready, later = [], []
        if self._pending.exists():
            for p in self._pending.get():
                (ready if p[0] <= upto else later).append(tuple(p))
        state = self._load()
        for ms, err, scale, fitted in sorted(ready, key=lambda p: (p[0], p[1] is None, p[1] or 0.0)):
            yield from self._overdue(key, state, ms - 1)
            yield from self._row(key, state, ms, err, scale)
            if fitted is not None and (state["fitted"] is None or fitted > state["fitted"]):
                state["fitted"], state["due"] = fitted, fitted + self._max_age
        yield from self._overdue(key, state, upto)
        if later:
            self._pending.put(later)
        else:
            self._pending.clear()
        times = [p[0] for p in later] + ([state["due"]] if state["due"] is not None else [])
        state["wake"] = None  # the timer that woke this call is gone
        self._wake(state, min(times, default=None))
        self._store(state)

    def _row(self, key, state, ms, err, scale) -> Iterator[Row]:
        state["ring"] = (state["ring"] + [err])[-self._window:]
        full = len(state["ring"]) == self._window and None not in state["ring"]
        mase = sum(state["ring"]) / self._window / scale if full and scale else None
        if mase is None or mase < self._limit:
            state["run"] = 0
            return
        state["run"] += 1
        if state["run"] == 1:
            state["since"] = ms
        if state["run"] == self._hold:
            yield self._alert(*key, "error", ms, state["since"])

    def _overdue(self, key, state, upto) -> Iterator[Row]:
        if state["due"] is not None and state["due"] <= upto:
            yield self._alert(*key, "age", state["due"], state["fitted"])
            state["due"] = None

    def _wake(self, state, at) -> None:
        if state["wake"] is not None and state["wake"] != at:
            self._handle.deleteTimer(state["wake"])
        if at is not None and at != state["wake"]:
            self._handle.registerTimer(at)
        state["wake"] = at

    def _load(self) -> dict:
        if not self._held.exists():
            return {"ring": [], "run": 0, "since": None, "fitted": None, "due": None, "wake": None}
        ring, run, since, fitted, due, wake = self._held.get()
        return {"ring": list(ring), "run": run, "since": since, "fitted": fitted, "due": due, "wake": wake}

    def _store(self, state: dict) -> None:
        self._held.update(tuple(state.values()))

    def close(self) -> None:
        pass


def retrain_alerts_stream(
    predictions: DataFrame,
    scale: DataFrame | float,
    window: int = 24,
    limit: float = 1.0,
    hold: int = 24,
    max_age_days: int = 30,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    lateness: str = "2 hours",
) -> DataFrame:
    """``monitor.retrain_alerts`` of a stream of predictions, in append mode.

    A prediction counts once the watermark, ``lateness`` behind the newest timestamp of the stream, has passed
    it; up to there the alerts are those of the batch, whatever the order of arrival, and later than that
    a row is left out. State per series and model: ``window`` errors, a few numbers, and the rows above the
    watermark. Needs the RocksDB state store (``spark.conf.set(PROVIDER, ROCKS_DB)``) and a session in UTC.
    ``scale`` is a number or a static table ``(keys, scale)``.
    """
    names = as_keys(keys)
    timed = predictions.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    slim = timed.select(
        *names, "model", ts, F.unix_millis(ts).alias("__ms"),
        F.abs(F.col("y_true") - F.col("y_pred")).cast("double").alias("__err"),
        F.unix_millis(F.col("fitted_at").cast("timestamp")).alias("__fitted"),
    ).dropna(subset=[*names, "model", ts])
    if isinstance(scale, DataFrame):
        rows = slim.join(scale.select(*names, F.col("scale").cast("double")), names, "left")
    else:
        rows = slim.withColumn("scale", F.lit(scale).cast("double"))
    grouping = [*names, "model"]
    fields = [StructField(n, rows.schema[n].dataType) for n in grouping]
    out = StructType([*fields, StructField("kind", StringType()), StructField("__at", LongType()), StructField("__since", LongType())])
    alerts = rows.groupBy(*grouping).transformWithState(
        statefulProcessor=_Alerts(out.names, window, limit, hold, max_age_days * DAY * 1000),
        outputStructType=out, outputMode="Append", timeMode="EventTime",
    )
    stamps = [F.timestamp_millis(c).cast("timestamp_ntz").alias(n) for c, n in (("__at", ts), ("__since", "since"))]
    return alerts.select(*grouping, "kind", *stamps)
