"""Nights from a tail against the matrix over the whole history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattgrid.operators import features as ft, nightly


def test_nights_equal_the_whole_history(spark, make):
    values = [float((i * 37) % 101) for i in range(700)]
    holed = list(values)
    holed[300] = None
    df = make({"a": values, "b": holed, "new": values[:100]})
    whole = ft.direct_matrix(ft.drop_warmup(ft.chronological_split(ft.build_features(df), "2024-01-02"))).drop("split")
    state = nightly.tail_state(df.where(F.col("ts") < F.lit("2024-01-28")))
    assert {r["n"] for r in state.select("series_id", F.size("tail").alias("n")).collect()} == {361, 100}
    for night in ("2024-01-28", "2024-01-29"):
        begin = F.lit(night).cast("timestamp_ntz")
        inside = (F.col("ts") >= begin) & (F.col("ts") < begin + F.expr("interval '1' day"))
        day = df.where(inside)
        got = {(r["series_id"], r["ts"]): r.asDict() for r in nightly.night_matrix(state, day).drop("split").collect()}
        expected = {(r["series_id"], r["ts"]): r.asDict() for r in whole.where(inside).collect()}
        assert got.keys() == expected.keys() and len(got) >= 40
        for k in got:
            names = [c for c, v in expected[k].items() if isinstance(v, (int, float))]
            assert [got[k][c] for c in names] == pytest.approx([expected[k][c] for c in names])
            assert got[k].keys() == expected[k].keys() and len(names) > 15
        state = nightly.merge_tails(state, nightly.tail_state(day))


def test_tails_merge_in_any_grouping_and_the_newer_decides(spark, make):
    a, b, c = (make({"a": v}, start=s) for v, s in (([1.0, 2.0, 3.0], "2024-01-01"), ([9.0, None], "2024-01-01 02:00"), ([5.0], "2024-01-01 04:00")))
    sa, sb, sc = (nightly.tail_state(x, 4) for x in (a, b, c))
    left = nightly.merge_tails(nightly.merge_tails(sa, sb, 4), sc, 4)
    right = nightly.merge_tails(sa, nightly.merge_tails(sb, sc, 4), 4)
    rows = [(r["ts"].hour, r["y"]) for r in nightly.tail_rows(left).orderBy("ts").collect()]
    assert rows == [(1, 2.0), (2, 9.0), (3, None), (4, 5.0)]
    assert left.collect() == right.collect()
    assert nightly.merge_tails(sa.limit(0), sb.limit(0)).count() == 0
    assert nightly.tail_state(a.limit(0)).count() == 0 and a.first()["ts"] == dt.datetime(2024, 1, 1)
