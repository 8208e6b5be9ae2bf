"""Long windows of values as slices of block arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattgrid.functions.timeaxis import as_keys, quoted, slot_sql
from wattgrid.plans.buckets import BUCKET, POSITION, bucket_rows, row_positions, with_halo


def block_windows(
    df: DataFrame,
    value: str,
    reach: int,
    last: int,
    name: str,
    *,
    keys: str | Sequence[str],
    ts: str,
    step: int,
    start: str | None = None,
    rows: int | None = None,
    gaps: str = "fail",
) -> DataFrame:
    """``(keys, ts, value, name)`` where ``name`` holds the values ``reach`` to ``last`` rows back, oldest first.

    A frame that collects its members builds each window from rows, member by member. Here every block
    of ``reach`` rows is collected once, together with the ``reach`` rows before it, into one sorted array, and a
    window is a slice of that array; the rows of the result are unfolded from it. A task holds the windows of
    one block, ``reach * reach`` values. Windows at the beginning of a series are shorter; NULL values
    stay in. ``start`` keeps the rows from that time on. ``gaps`` as in ``over_neighbours``.
    """
    if gaps not in ("fail", "rows"):
        raise ValueError(f"gaps must be 'fail' or 'rows', not {gaps!r}")
    names = as_keys(keys)
    width = bucket_rows(reach, reach if rows is None else rows)
    slim = df.select(*names, ts, value).dropna(subset=[*names, ts])
    if gaps == "rows":
        source, place = row_positions(slim, keys=names, ts=ts, step=step, name=POSITION), POSITION
    else:
        source, place = slim, slot_sql(ts, step)
    t, v = quoted(ts), quoted(value)
    placed = with_halo(source, place, before=reach, rows=width).selectExpr(
        *map(quoted, names), BUCKET, f"named_struct('p', {place}, 't', {t}, 'v', {v}) AS __row"
    )
    blocks = placed.groupBy(*names, BUCKET).agg(F.sort_array(F.collect_list("__row")).alias("__rows"))
    arrays = blocks.selectExpr("*", "transform(__rows, x -> x.v) AS __v", f"size(filter(__rows, x -> x.p < {BUCKET} * {width})) AS __halo")
    if gaps == "fail":
        hole = "exists(sequence(1, size(__rows)), i -> i > 1 AND element_at(__rows, i).p - element_at(__rows, i - 1).p > 1)"
        message = "a step is missing in the block that starts at %s; complete the grid or ask for gaps='rows'"
        broken = F.raise_error(F.format_string(message, F.expr("cast(__rows[0].t AS string)"))).cast("int")
        arrays = arrays.withColumn("__halo", F.when(F.expr(hole), broken).otherwise(F.col("__halo")))
    kept = "" if start is None else f"AND __rows[i - 1].t >= timestamp_ntz'{start}'"
    own = f"filter(sequence(1, size(__rows)), i -> i > __halo {kept})"
    window = f"slice(__v, greatest(1, i - {reach}), greatest(0, i - {last} - greatest(1, i - {reach}) + 1))"
    made = f"transform({own}, i -> named_struct('t', __rows[i - 1].t, 'v', __rows[i - 1].v, 'w', {window}))"
    unfolded = arrays.selectExpr(*map(quoted, names), f"inline({made}) AS ({t}, {v}, {quoted(name)})")
    return unfolded
