"""Boosted trees next to a plain recursive implementation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import trees

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 5, 400), rng.normal(size=400).round(1), np.full(400, 2.0)])
    y = 3 * (x[:, 0] > 0.3) + x[:, 1] - 2 * (x[:, 2] > 0) * (x[:, 0] < 0) + rng.normal(0, 0.3, 400)
    return x, y, np.arange(400) * 3 // 400


@pytest.fixture(scope="module")
def frame(spark, table):
    x, y, fold = table
    rows = [(int(i % 2), int(i), float(y[i]), int(fold[i]), *map(float, x[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "series_id bigint, i bigint, y double, own_fold int, " + ", ".join(f"{f} double" for f in FEATURES)).repartition(3)


def cuts(x, bins):
    return [sorted({np.sort(column)[int(np.ceil(k * len(column) / bins)) - 1] for k in range(1, bins)}) for column in x.T]


def grow(x, g, edges, p, depth):
    """A tree as nested tuples (feature, edge, left, right) or a leaf's weight."""
    t = lambda v: np.sign(v) * max(abs(v) - p.l1, 0)
    leaf = -p.rate * t(g.sum()) / (len(g) + p.l2)
    best = None
    for f, cut in enumerate(edges):
        for edge in cut:
            left = x[:, f] < edge
            if not depth or min(left.sum(), (~left).sum()) < p.min_weight:
                continue
            gain = t(g[left].sum()) ** 2 / (left.sum() + p.l2) + t(g[~left].sum()) ** 2 / ((~left).sum() + p.l2) - t(g.sum()) ** 2 / (len(g) + p.l2)
            if gain / 2 > 1e-12 and (best is None or gain > best[0] * (1 + 1e-9)):
                best = (gain, f, edge, left)
    if best is None:
        return leaf
    _, f, edge, left = best
    return f, edge, grow(x[left], g[left], edges, p, depth - 1), grow(x[~left], g[~left], edges, p, depth - 1)


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


def boosted(x, y, train, edges, p):
    now, errors = np.full(len(y), y[train].mean()), []
    for _ in range(p.rounds):
        tree = grow(x[train], (now - y)[train], edges, p, p.depth)
        now = now + np.array([walk(tree, row) for row in x])
        errors.append(now)
    return errors


def predicted(frame, model, target="y"):
    made = trees.score({"m": model}, frame, ts="i")
    return np.array([r["y_pred"] for r in made.orderBy("i").collect()])


@pytest.mark.parametrize("stored_every", [2, 100])
def test_equals_plain_boosting(frame, table, monkeypatch, stored_every):
    """Candidates of different depths, rounds and penalties over two folds, all grown together."""
    monkeypatch.setattr(trees, "STORED_EVERY", stored_every)
    x, y, fold = table
    whole = dict(row_share=1.0, column_share=1.0)
    candidates = [
        trees.TreeParams(rounds=5, depth=3, rate=0.3, min_weight=5, l1=0.5, l2=2.0, **whole),
        trees.TreeParams(rounds=3, depth=1, rate=0.5, min_weight=1, **whole),
        trees.TreeParams(rounds=4, depth=2, rate=0.1, min_weight=60, l2=0.0, **whole),
    ]
    jobs = [(p, f) for p in candidates for f in (1, 2)]
    models = trees.fit_many(frame, FEATURES, jobs, bins=16)
    edges = cuts(x[fold < 2], 16)
    assert models[0].edges == edges
    for (p, f), model in zip(jobs, models):
        assert len(model.trees) == p.rounds
        np.testing.assert_allclose(predicted(frame, model), boosted(x, y, fold < f, edges, p)[-1], atol=1e-9)
    errors = trees.validation_errors(models, frame)
    for (p, f), found in zip(jobs, errors):
        assert found == pytest.approx(np.abs(boosted(x, y, fold < f, edges, p)[-1] - y)[fold == f].mean())


def test_stops_without_progress(frame, table):
    x, y, fold = table
    p = trees.TreeParams(rounds=60, depth=2, rate=0.9, row_share=1.0, column_share=1.0, min_weight=1)
    model = trees.fit_many(frame, FEATURES, [(p, 1)], patience=3, bins=16)[0]
    edges = cuts(x[fold < 1], 16)
    rounds = boosted(x, y, fold < 1, edges, p)
    mae = [np.abs(y[fold < 1].mean() - y)[fold == 1].mean()] + [np.abs(r - y)[fold == 1].mean() for r in rounds]
    best = next(i for i in range(len(mae)) if len(mae) - i <= 3 or min(mae[i + 1 : i + 4]) >= mae[i])
    assert model.best_round == best == len(model.trees) < 60
    assert len(model.val_mae) == best + 4
    np.testing.assert_allclose(model.val_mae, mae[: best + 4])
    np.testing.assert_allclose(predicted(frame, model), rounds[best - 1], atol=1e-9)


def test_draws_are_repeatable_and_partial(frame):
    p = trees.TreeParams(rounds=6, depth=2, rate=0.3, row_share=0.6, column_share=0.5)
    one, two = (trees.fit_many(f, FEATURES, [(p, 2)])[0] for f in (frame, frame.repartition(5)))
    assert [t.feature.tolist() for t in one.trees] == [t.feature.tolist() for t in two.trees]
    np.testing.assert_allclose([t.value for t in one.trees], [t.value for t in two.trees])
    for t in one.trees:
        assert len(set(t.feature[t.feature >= 0])) <= 2
    assert len({tuple(t.feature) for t in one.trees}) > 1


def test_missing_values_and_constant_targets(spark):
    rows = [(0, i, 1.0 if i % 3 else 5.0, 0, None if i % 3 == 0 else float(i % 7), float("nan") if i % 3 == 0 else 1.0) for i in range(60)]
    frame = spark.createDataFrame([*rows, (0, 99, None, 0, 1.0, 1.0)], "series_id int, i int, y double, own_fold int, a double, b double")
    p = trees.TreeParams(rounds=1, depth=1, rate=1.0, row_share=1.0, column_share=1.0, min_weight=1, l2=0.0)
    model = trees.fit_many(frame, ["a", "b"], [(p, 1)])[0]
    found = {r["i"]: r["y_pred"] for r in trees.score({"m": model}, frame, ts="i").collect()}
    assert found[0] == pytest.approx(5.0) and found[1] == pytest.approx(1.0)
    flat = trees.fit_many(frame.withColumn("y", F.lit(2.0)), ["a", "b"], [(p, 1)])[0]
    assert (flat.trees[0].feature == -1).all() and flat.base == 2.0


def test_search_and_folds(spark, make):
    rng = np.random.default_rng(1)
    n = 240
    series = make({"s": (np.arange(n) % 24) + rng.normal(0, 0.1, n)}).withColumn("hour", F.hour("ts")).withColumn("noise", F.xxhash64("ts") % 7)
    matrix = series.withColumn("split", F.when(F.col("ts") < "2024-01-09", "train").otherwise("test"))
    weak = trees.TreeParams(rounds=1, depth=1, rate=0.01)
    good = trees.TreeParams(rounds=6, depth=4, rate=0.5, row_share=1.0, column_share=1.0, min_weight=1)
    model, means = trees.search(matrix, ["hour", "noise"], [weak, good], n_splits=3)
    assert model.params == good and means[1] < means[0]
    folds = trees.cross_validate(matrix, ["hour", "noise"], good, n_splits=3).collect()
    assert sorted(r["fold"] for r in folds) == [1, 2, 3]
    assert np.mean([r["val_mae"] for r in folds]) == pytest.approx(means[1])
    assert all(r["train_mae"] < r["val_mae"] * 3 + 1 for r in folds)
    best = trees.importances(spark, model, 1).first()
    assert best["feature"] == "hour" and best["importance"] > 0.5
    stopped = trees.fit_early_stopping(matrix, ["hour", "noise"], good, patience=2)
    assert 1 <= stopped.best_round <= 6
