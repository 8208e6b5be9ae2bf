"""Zone-free arithmetic on a regular time axis.

Meter timestamps are naive wall-clock values (TIMESTAMP_NTZ). Everything here works on
that wall clock, so the session time zone never moves an hour into another bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MINUTE = 60
HOUR = 3600
DAY = 86400

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def as_keys(keys: str | list[str] | tuple[str, ...]) -> list[str]:
    """Series key columns as a list; a single name is accepted."""
    return [keys] if isinstance(keys, str) else list(keys)


def quoted(name: str) -> str:
    """A column name for use inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_sql(ts: str) -> str:
    """SQL text for the whole seconds since 1970-01-01 of a timestamp column."""
    return f"cast(cast((cast({quoted(ts)} AS timestamp_ntz) - {_EPOCH}) AS interval second) AS bigint)"


def slot_sql(ts: str, step: int) -> str:
    """SQL text for :func:`slot`."""
    return f"cast(floor({seconds_sql(ts)} / {step}) AS bigint)"


def naive(ts: str | Column) -> Column:
    """The timestamp as TIMESTAMP_NTZ (a no-op for columns that already are)."""
    return _col(ts).cast("timestamp_ntz")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock."""
    if isinstance(ts, str):
        return F.expr(seconds_sql(ts))
    return (naive(ts) - F.expr(_EPOCH)).cast("interval second").cast("bigint")


def from_epoch(seconds: str | Column) -> Column:
    """Inverse of :func:`epoch_seconds`."""
    return F.expr(_EPOCH) + F.expr("interval '1' second") * _col(seconds)


def plus_seconds(ts: str | Column, seconds: str | Column | int) -> Column:
    """``ts`` moved by a number of seconds, sub-second part kept."""
    amount = F.lit(seconds) if isinstance(seconds, int) else _col(seconds)
    return naive(ts) + F.expr("interval '1' second") * amount


def slot(ts: str | Column, step: int) -> Column:
    """Position on the grid of ``step`` seconds: consecutive grid points differ by one."""
    if isinstance(ts, str):
        return F.expr(slot_sql(ts, step))
    return F.floor(epoch_seconds(ts) / F.lit(step)).cast("bigint")


def floor_to(ts: str | Column, step: int) -> Column:
    """Start of the ``step``-second bucket that holds ``ts``."""
    if isinstance(ts, str):
        return F.expr(f"{_EPOCH} + interval '1' second * ({slot_sql(ts, step)} * {step})")
    return from_epoch(slot(ts, step) * F.lit(step))


def seconds_between(earlier: str | Column, later: str | Column) -> Column:
    """``later - earlier`` in seconds as a double, fractions kept."""
    delta = (naive(later) - naive(earlier)).cast("interval second")
    return delta.cast("decimal(20,6)").cast("double")


def lit_ts(value: str) -> Column:
    """A naive timestamp literal from ISO text."""
    return F.lit(value).cast("timestamp_ntz")


def calendar_part(name: str, ts: str | Column) -> Column:
    """One calendar attribute; ``dayofweek`` counts from Monday = 0."""
    t = _col(ts)
    parts = {
        "hour": F.hour,
        "dayofweek": F.weekday,
        "day_of_week": F.weekday,
        "day": F.day,
        "month": F.month,
        "quarter": F.quarter,
        "year": F.year,
    }
    if name not in parts:
        raise ValueError(f"unknown calendar attribute {name!r}; choose from {sorted(parts)}")
    return parts[name](t)
