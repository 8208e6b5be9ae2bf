import pytest

import __spark_entry__ as entry
from check_queries import connect, difference

DATA = "/root/testdata/sf0.01"
CHECKED = [
    "src2_compose_timestamp", "dq5_audit", "cl6_clean_and_resample", "fe9_model_matrix", "mt8_leaderboard",
    "cv1_expanding_folds", "st1_kruskal_month", "ex3_box_statistics", "ex5_histogram", "fe3_lag_features_gappy",
    "fe12_context_windows", "snk3_save_predictions", "snk6_reuse_predictions", "st4_ljung_box", "st6_kpss", "ex10_actual_vs_predicted",
]


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r["model"] for r in rows} == {"naive_lag1", "naive_lag24", "naive_lag168"}


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    ours = entry.queries()[name](spark, DATA).toPandas()
    assert difference(ours, connect(DATA).sql(entry.oracle_sql()[name]).df()) is None


def test_cv4_runs_all_folds(spark):
    found = entry.queries()["cv4_cv_seasonal_ar"](spark, DATA)
    assert found.agg({"fold": "max"}).first()[0] == 5
