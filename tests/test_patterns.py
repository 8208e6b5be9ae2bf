import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattgrid.plans.buckets import attach, expand, row_positions
from wattgrid.plans.ranks import cumulative, exact_quantiles, quantile_table


@pytest.fixture(scope="module")
def skewed(spark):
    """A group with most rows, a third of them one value, and small groups."""
    rng = np.random.default_rng(1)
    big = np.round(rng.gamma(1, 100, 4000), 1)
    big[:1500] = 50.0
    rows = [("big", float(v)) for v in big] + [("small", float(v)) for v in (3, 1, 2, 2)] + [("one", 7.0)]
    return pd.DataFrame(rows, columns=["k", "v"]), spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize("ranges, per", [(512, 65536), (16, 10), (64, 1)])
def test_cumulative_counts_equal_ranks(skewed, ranges, per):
    pdf, df = skewed
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = cumulative(counts, "k", "v", ranges=ranges, rows_per_range=per).toPandas().sort_values(["k", "v"])
    ranks = pdf.groupby("k")["v"].rank(method="max")
    want = pdf.assign(upto=ranks).drop_duplicates().sort_values(["k", "v"])
    assert got["upto"].tolist() == want["upto"].astype(int).tolist()
    assert got.set_index(["k", "v"]).loc[("big", 50.0), "ties"] == (pdf.v == 50.0).sum()
    assert set(got.loc[got.k == "big", "total"]) == {4000}


@pytest.mark.parametrize("per", [65536, 5])
def test_quantiles_are_exact(skewed, per):
    pdf, df = skewed
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = quantile_table(cumulative(counts, "k", "v", ranges=32, rows_per_range=per), "k", "v", probabilities).toPandas().set_index("k")
    for k, part in pdf.groupby("k"):
        want = np.quantile(part["v"], probabilities)
        np.testing.assert_allclose(got.loc[k, [f"q{i}" for i in range(6)]].astype(float), want, rtol=1e-12)


@pytest.mark.parametrize("ranges, small", [(512, 4096), (32, 5), (4, 0)])
def test_quantiles_of_plain_rows_are_exact(skewed, ranges, small):
    pdf, df = skewed
    odd = df.unionByName(df.sparkSession.createDataFrame([(None, 1.0), ("big", None), ("none", None)], "k string, v double"))
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = exact_quantiles(odd, "k", "v", probabilities, ranges=ranges, small=small).toPandas().set_index("k")
    assert got["n"].to_dict() == pdf.groupby("k").size().to_dict()
    for k, part in pdf.groupby("k"):
        want = np.quantile(part["v"], probabilities)
        np.testing.assert_allclose(got.loc[k, [f"q{i}" for i in range(6)]].astype(float), want, rtol=1e-12)


def test_expand_keeps_every_integer(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 5, 5), ("c", 3, 2)], "k string, lo long, hi long")
    got = sorted((r["k"], r["i"]) for r in expand(df, "lo", "hi", "i", chunk=4).collect())
    assert got == [("a", i) for i in range(1, 11)] + [("b", 5)]


def test_attach_spreads_identical_rows(spark):
    rows = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("k"), F.lit(1.0).alias("x"))
    scalars = spark.createDataFrame([("hot", 2.0)], "k string, m double")
    joined = attach(rows, scalars, "k")
    assert joined.count() == 4000 and joined.agg(F.sum("m")).first()[0] == 8000.0
    assert joined.columns == ["k", "x", "m"]


@pytest.mark.parametrize("rows", [4, 1000])
def test_row_positions_with_gaps(make, rows):
    v = np.arange(100.0)
    df = make({"a": v, "b": v[:7]}).where(F.col("y") % 3 != 1)
    got = row_positions(df, keys="series_id", ts="ts", step=3600, total="n", rows=rows).orderBy("series_id", "ts").toPandas()
    for k, part in got.groupby("series_id"):
        assert part["pos"].tolist() == list(range(len(part))) and set(part["n"]) == {len(part)}


def test_discarded_stages_are_empty_and_others_stay(spark):
    from wattgrid.session import discard, staged

    first = staged(spark.range(1000).withColumn("x", F.col("id") * 2))
    second = staged(first.where("id < 10"))
    folder = first.inputFiles()[0].rsplit("/", 1)[0]
    discard(first.select("x"))
    assert spark.read.parquet(folder).count() == 0 and second.count() == 10
    discard(spark.range(3))
