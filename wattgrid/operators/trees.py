"""Gradient-boosted regression trees on binned features, many models at once.

Features are binned once, by quantiles of the training rows. Trees grow level by level: each task adds
gradients and row counts per (model, node, feature, bin) into dense arrays, the arrays are summed by Spark per
(model, node), and only the chosen split of each node reaches the driver. One such aggregation advances one
level of the current tree of *all* models, so a search over candidates and folds takes as many jobs
as its deepest, longest candidate alone. What a task holds and sends depends on models, nodes, features and
bins, not on its rows.

The rules are those of second-order boosting on squared error: a leaf's weight is ``-T(G) / (H + l2)`` and a
split's gain ``T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2)`` over two, where ``G`` and ``H`` are
the sums of gradients and of rows, and ``T`` moves ``G`` towards zero by ``l1``. Each tree draws rows and
columns anew; a child needs ``min_weight`` rows. Equal gains (to nine digits) go to the first feature and
the lowest bin. A missing value is below all bins. A model stops after ``patience`` rounds without a lower mean
absolute error on its validation rows, and keeps the rounds up to the best one.

Current forecasts of all models are stored with the rows every few rounds, so lineage and the trees to
walk stay short, and lost executors repeat a few rounds at most.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattgrid.functions.timeaxis import HOUR, as_keys
from wattgrid.operators.validation import N_SPLITS, fold_index
from wattgrid.plans.buckets import row_positions
from wattgrid.session import staged

BINS = 64
STORED_EVERY = 8
SALTS = 32
FOLD = "own_fold"
SEED = 42


@dataclass(frozen=True)
class TreeParams:
    """Settings of one boosted model."""

    rounds: int = 500
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_weight: float = 5.0
    l1: float = 0.0
    l2: float = 1.0
    seed: int = SEED


# The tuned configuration of the next-hour model, shared by the day-ahead model.
TUNED = TreeParams(
    rounds=221, depth=6, rate=0.03567663137948074, row_share=0.8099098641033556, column_share=0.6727299868828402,
    min_weight=10.0, l1=0.007066305219717406, l2=1.092249700165663,
)


def draw_params(n: int = 20, seed: int = SEED, rounds: tuple[int, int] = (200, 1000)) -> list[TreeParams]:
    """Reproducible random candidates over the search ranges."""
    rng = np.random.default_rng(seed)
    return [
        TreeParams(
            rounds=int(rng.integers(*rounds)), depth=int(rng.integers(3, 9)), rate=float(rng.uniform(0.01, 0.15)),
            row_share=float(rng.uniform(0.6, 1.0)), column_share=float(rng.uniform(0.6, 1.0)),
            min_weight=float(rng.integers(1, 11)), l1=float(rng.uniform(0.0, 1.0)), l2=float(rng.uniform(1.0, 5.0)), seed=seed,
        )
        for _ in range(n)
    ]


@dataclass
class Tree:
    """A complete binary tree by heap position: 0 is the root, ``2 i + 1`` and ``2 i + 2`` are children.
    ``feature`` is -1 where a position is not split; ``value`` is the (shrunk) weight of each position."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size))

    def position(self, binned: np.ndarray, levels: int) -> np.ndarray:
        """Where each row stands after at most ``levels`` splits."""
        at = np.zeros(len(binned), np.int64)
        for _ in range(levels):
            f = self.feature[at]
            right = binned[np.arange(len(binned)), np.maximum(f, 0)] > self.bin[at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return at

    def walk(self, binned: np.ndarray) -> np.ndarray:
        return self.value[self.position(binned, int(np.log2(len(self.feature) + 1)) - 1)]


@dataclass
class Boosted:
    """A fitted model. ``fold`` bounds its training rows; ``base`` is their mean; ``val_mae`` are the errors
    on the validation rows after 0, 1, 2, ... rounds."""

    params: TreeParams
    features: list[str]
    edges: list[list[float]]
    fold: int
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    val_mae: list[float] = field(default_factory=list)
    best_round: int = 0

    def predict(self, binned: np.ndarray) -> np.ndarray:
        out = np.full(len(binned), self.base)
        for tree in self.trees:
            out += tree.walk(binned)
        return out


def bin_edges(matrix: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """The different ``1/bins, 2/bins, ...`` quantiles of each feature, from a mergeable sketch of bounded size."""
    share = [k / bins for k in range(1, bins)]
    row = matrix.agg(*[F.percentile_approx(F.col(f"`{f}`").cast("double"), share, 10_000).alias(f"e{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(row[f"e{i}"] or [])) for i in range(len(features))]


def _binned(columns: list[pa.Array], edges: list[list[float]]) -> np.ndarray:
    """The number of edges at or below each value, by row and feature; 0 for missing values."""
    out = np.zeros((len(columns[0]) if columns else 0, len(edges)), np.int16)
    for i, (column, cuts) in enumerate(zip(columns, edges)):
        x = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(np.array(cuts), x, side="right"))
    return out


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A two-dimensional array as a column of lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _square(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _prepared(matrix: DataFrame, features: list[str], edges: list[list[float]], target: str, bases: list[float]) -> DataFrame:
    """``row, own_fold, y, bins, margin``: stored rows with their bins and the first forecasts of all models."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _binned([batch[f"f{i}"] for i in range(len(features))], edges)
            margin = np.tile(np.array(bases), (batch.num_rows, 1))
            columns = [batch["row"], batch[FOLD], batch["y"], _listed(bins, pa.int16()), _listed(margin, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", FOLD, "y", "bins", "margin"])

    picked = [F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    plain = [F.col(f"`{c}`") for c, t in matrix.dtypes if "map<" not in t]
    # A row's number follows from its content, so that every recomputation draws the same rows.
    rows = matrix.select(F.xxhash64(*plain).alias("row"), F.col(FOLD).cast("int").alias(FOLD), F.col(target).cast("double").alias("y"), *picked)
    return staged(rows.where("y is not null").mapInArrow(prepare, f"row bigint, {FOLD} int, y double, bins array<smallint>, margin array<double>"))


def _drawn(rows: np.ndarray, params: TreeParams, turn: int) -> np.ndarray:
    """Which rows the tree of this turn is grown on."""
    if params.row_share >= 1:
        return np.ones(len(rows), bool)
    h = rows.view(np.uint64) + np.uint64(((params.seed + 1) * 0x9E3779B97F4A7C15 + turn * 0xD1342543DE82EF95) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) < np.uint64(int(params.row_share * (2**64 - 1)))


def _columns(params: TreeParams, n: int, turn: int) -> np.ndarray:
    """The features that the tree of this turn may use."""
    if params.column_share >= 1:
        return np.arange(n)
    rng = np.random.default_rng([params.seed, turn])
    return np.sort(rng.choice(n, max(1, int(params.column_share * n)), replace=False))


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_split(g: np.ndarray, h: np.ndarray, params: TreeParams) -> tuple[int, int, float]:
    """Feature, bin and gain of the best split (feature -1 if there is none) from the node's sums by feature
    and bin; rows of features that the tree may not use are zero."""
    whole_g, whole_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    right_g, right_h = whole_g - left_g, whole_h - left_h
    score = lambda x, y: _shrunk(x, params.l1) ** 2 / np.maximum(y + params.l2, 1e-300)
    gain = (score(left_g, left_h) + score(right_g, right_h) - score(whole_g, whole_h)) / 2
    least = max(params.min_weight, 1.0)
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
    top = gain.max(initial=-np.inf)
    if not top > 1e-12:
        return -1, 0, 0.0
    near = np.flatnonzero(gain.ravel() >= top - 1e-9 * abs(top))[0]
    return int(near // gain.shape[1]), int(near % gain.shape[1]), float(gain.ravel()[near])


_SUMS = "model int, node int, g binary, h binary"
_SPLITS = "model int, node int, feature int, bin int, gain double, g double, h double, left_g double, left_h double"


def _added(key: tuple, table: pa.Table) -> pa.Table:
    g, h = (np.sum([np.frombuffer(x.as_py()) for x in table[c]], axis=0) for c in ("g", "h"))
    ids = [pa.array([key[i].as_py()], pa.int32()) for i in (0, 1)]
    return pa.table([*ids, pa.array([g.tobytes()]), pa.array([h.tobytes()])], names=["model", "node", "g", "h"])


class _Fit:
    """The state of models that grow together."""

    def __init__(self, rows: DataFrame, models: list[Boosted], bins: int):
        self.rows, self.models, self.bins = rows, models, bins
        self.active = list(range(len(models)))
        self.pending: list[list[Tree]] = [[] for _ in models]  # trees that the stored forecasts do not include
        self.turn = 0
        self.salted = rows.rdd.getNumPartitions() > SALTS

    def _sums(self, growing: dict[int, Tree], level: int) -> DataFrame:
        """Gradient and row sums of each model's nodes of a level, one row per task; before the first level
        also the validation errors, as node -1."""
        models = {m: (self.models[m].params, self.models[m].fold, self.pending[m], tree) for m, tree in growing.items()}
        n_features, n_models, bins, turn = len(self.models[0].features), len(self.models), self.bins, self.turn

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, nodes = 2**level - 1, 2**level
            total = {m: np.zeros((2, nodes * n_features * bins)) for m in models}
            errors = {m: np.zeros(2) for m in models}
            used = {m: _columns(params, n_features, turn) for m, (params, *_) in models.items()}
            for batch in batches:
                x, fold = _square(batch["bins"], n_features).astype(np.int64), batch[FOLD].to_numpy(zero_copy_only=False)
                y, row = batch["y"].to_numpy(zero_copy_only=False), batch["row"].to_numpy(zero_copy_only=False)
                margin = _square(batch["margin"], n_models)
                for m, (params, bound, pending, tree) in models.items():
                    now = margin[:, m] + sum((t.walk(x) for t in pending), np.zeros(len(x)))
                    if not level:
                        held = fold == bound
                        errors[m] += [np.abs(now - y)[held].sum(), held.sum()]
                    chosen = np.flatnonzero((fold < bound) & _drawn(row, params, turn))
                    at = tree.position(x[chosen], level) - first
                    chosen, at = chosen[at >= 0], at[at >= 0]  # rows whose node was not split stay above
                    cell = ((at[:, None] * n_features + used[m]) * bins + x[np.ix_(chosen, used[m])]).ravel()
                    g = np.repeat(now[chosen] - y[chosen], len(used[m]))
                    total[m][0] += np.bincount(cell, g, minlength=total[m].shape[1])
                    total[m][1] += np.bincount(cell, minlength=total[m].shape[1])
            out = []
            for m in models:
                shaped = total[m].reshape(2, nodes, n_features * bins)
                out += [(m, node, shaped[0, node].tobytes(), shaped[1, node].tobytes()) for node in np.flatnonzero(shaped[1].any(axis=1)).tolist()]
                if errors[m][1]:
                    out.append((m, -1, errors[m][:1].tobytes(), errors[m][1:].tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "node", "g", "h"])

        return self.rows.mapInArrow(add, _SUMS)

    def _splits(self, growing: dict[int, Tree], level: int) -> list:
        """The chosen split of each node, and its sums."""
        n_features, bins, turn = len(self.models[0].features), self.bins, self.turn
        params = {m: self.models[m].params for m in growing}

        def choose(key: tuple, table: pa.Table) -> pa.Table:
            summed = _added(key, table)
            g, h = (np.frombuffer(summed[c][0].as_py()) for c in ("g", "h"))
            m, node = (k.as_py() for k in key)
            if node < 0:
                found = (-1, 0, 0.0, g[0], h[0], 0.0, 0.0)
            else:
                g, h = g.reshape(n_features, bins), h.reshape(n_features, bins)
                some = int(_columns(params[m], n_features, turn)[0])  # every used feature has the same totals
                f, b, gain = best_split(g, h, params[m])
                left = (g[f, : b + 1].sum(), h[f, : b + 1].sum()) if f >= 0 else (0.0, 0.0)
                found = (f, b, gain, g[some].sum(), h[some].sum(), *left)
            names = [c.split()[0] for c in _SPLITS.split(", ")]
            kinds = [pa.int32()] * 4 + [pa.float64()] * 5
            return pa.table([pa.array([v], kind) for v, kind in zip((m, node, *found), kinds)], names=names)

        sums = self._sums(growing, level)
        if self.salted:
            salted = sums.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
            sums = salted.groupBy("model", "node", "salt").applyInArrow(lambda key, t: _added(key, t), _SUMS)
        return sums.groupBy("model", "node").applyInArrow(choose, _SPLITS).collect()

    def _grow(self, patience: int | None) -> dict[int, Tree]:
        """One tree of every active model."""
        growing = {m: Tree.empty(self.models[m].params.depth) for m in self.active}
        deepest = max(self.models[m].params.depth for m in self.active)
        for level in range(max(deepest, 1)):
            open_ = {m: t for m, t in growing.items() if level < self.models[m].params.depth and (not level or (t.feature[2 ** (level - 1) - 1 : 2**level - 1] >= 0).any())}
            if not open_:
                break
            for r in self._splits(open_, level):
                model, tree = self.models[r["model"]], growing[r["model"]]
                if r["node"] < 0:
                    model.val_mae.append(r["g"] / r["h"])
                    continue
                p, at = model.params, 2**level - 1 + r["node"]
                weight = lambda g, h: float(-p.rate * _shrunk(np.array(g), p.l1) / (h + p.l2))  # noqa: E731, B023
                tree.value[at] = weight(r["g"], r["h"])
                if r["feature"] >= 0:
                    tree.feature[at], tree.bin[at], tree.gain[at] = r["feature"], r["bin"], r["gain"]
                    tree.value[2 * at + 1] = weight(r["left_g"], r["left_h"])
                    tree.value[2 * at + 2] = weight(r["g"] - r["left_g"], r["h"] - r["left_h"])
            if not level and patience is not None:
                for m in list(growing):
                    errors = self.models[m].val_mae
                    if errors and len(errors) - 1 - int(np.argmin(errors)) >= patience:
                        growing.pop(m)
        return growing

    def _store(self) -> None:
        """Store the forecasts with all trees so far."""
        pending, n_features, n_models = self.pending, len(self.models[0].features), len(self.models)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, margin = _square(batch["bins"], n_features).astype(np.int64), _square(batch["margin"], n_models).copy()
                for m, trees in enumerate(pending):
                    for tree in trees:
                        margin[:, m] += tree.walk(x)
                columns = [batch[c] for c in ("row", FOLD, "y", "bins")]
                yield pa.RecordBatch.from_arrays([*columns, _listed(margin, pa.float64())], names=["row", FOLD, "y", "bins", "margin"])

        self.rows = staged(self.rows.mapInArrow(add, self.rows.schema))
        self.pending = [[] for _ in self.models]

    def run(self, patience: int | None) -> None:
        while self.active:
            grown = self._grow(patience)
            for m, tree in grown.items():
                self.models[m].trees.append(tree)
                self.pending[m].append(tree)
            self.turn += 1
            self.active = [m for m in grown if len(self.models[m].trees) < self.models[m].params.rounds]
            if self.active and self.turn % STORED_EVERY == 0:
                self._store()
        for model in self.models:
            model.best_round = int(np.argmin(model.val_mae)) if patience is not None and model.val_mae else len(model.trees)
            model.trees = model.trees[: model.best_round] if patience is not None and model.val_mae else model.trees


def fit_many(
    matrix: DataFrame,
    features: Sequence[str],
    jobs: Sequence[tuple[TreeParams, int]],
    target: str = "y",
    patience: int | None = None,
    bins: int = BINS,
) -> list[Boosted]:
    """Fit one model per job ``(params, fold)`` together, on rows whose ``own_fold`` is below ``fold``. Rows of
    ``own_fold = fold`` are the model's validation rows; with ``patience`` they decide when to stop. The
    error after the last round is measured only where ``patience`` is given."""
    names = list(features)
    train = matrix.where(F.col(FOLD) < max(f for _, f in jobs))
    edges = bin_edges(train, names, bins)
    means = matrix.agg(*[F.avg(F.when(F.col(FOLD) < f, F.col(target).cast("double"))).alias(f"m{f}") for f in sorted({f for _, f in jobs})]).first()
    models = [Boosted(p, names, edges, f, base=float(means[f"m{f}"] or 0.0)) for p, f in jobs]
    rows = _prepared(matrix, names, edges, target, [m.base for m in models])
    _Fit(rows, models, bins).run(patience)
    return models


def fit(matrix: DataFrame, features: Sequence[str], params: TreeParams = TUNED, target: str = "y", bins: int = BINS) -> Boosted:
    """Fixed settings on all rows of the split ``train``."""
    marked = matrix.where(F.col("split") == "train").withColumn(FOLD, F.lit(0))
    return fit_many(marked, features, [(params, 1)], target, None, bins)[0]


def search(
    matrix: DataFrame,
    features: Sequence[str],
    candidates: Sequence[TreeParams],
    target: str = "y",
    n_splits: int = N_SPLITS,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    bins: int = BINS,
) -> tuple[Boosted, list[float]]:
    """The best candidate by its mean error over expanding folds, refitted on all training rows, and the mean
    of each candidate. All candidates and folds grow together."""
    train = matrix.where(F.col("split") == "train")
    tagged = staged(fold_index(train, n_splits, keys, ts, step))
    models = fit_many(tagged, features, [(p, f) for p in candidates for f in range(1, n_splits + 1)], target, None, bins)
    errors = validation_errors(models, tagged, target)
    means = [float(np.mean(errors[i * n_splits : (i + 1) * n_splits])) for i in range(len(candidates))]
    return fit(matrix, features, candidates[int(np.argmin(means))], target, bins), means


def _predicted(models: list[Boosted], matrix: DataFrame, target: str, kept: list[str]) -> DataFrame:
    """``kept``, ``y_true`` and the list ``all`` of all models' forecasts."""
    first = models[0]
    picked = [F.col(f"`{f}`").cast("double").alias(f"__f{i}") for i, f in enumerate(first.features)]
    slim = matrix.select(*kept, F.col(target).cast("double").alias("y_true"), *picked)
    kept = [*kept, "y_true"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _binned([batch[f"__f{i}"] for i in range(len(first.features))], first.edges).astype(np.int64)
            made = np.column_stack([m.predict(x) for m in models])
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], _listed(made, pa.float64())], names=[*kept, "all"])

    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in kept) + ", all array<double>"
    return slim.mapInArrow(predict, schema)


def validation_errors(models: list[Boosted], tagged: DataFrame, target: str = "y") -> list[float]:
    """Mean absolute error of each model on the rows of its own fold, over all series; one pass."""
    made = _predicted(models, tagged, target, [FOLD]).select(FOLD, "y_true", F.posexplode("all").alias("m", "y_pred"))
    bounds = F.array(*[F.lit(m.fold) for m in models])
    own = made.where(F.col(FOLD) == F.get(bounds, F.col("m"))).groupBy("m").agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"))
    found = {r["m"]: r["mae"] for r in own.collect()}
    return [found.get(i, float("inf")) for i in range(len(models))]


def cross_validate(
    matrix: DataFrame,
    features: Sequence[str],
    params: TreeParams,
    target: str = "y",
    n_splits: int = N_SPLITS,
    name: str = "boosted",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    bins: int = BINS,
) -> DataFrame:
    """Fold table with validation and training error per series; the models of all folds grow together, so
    ``fit_seconds`` is each fold's share of the time."""
    names = as_keys(keys)
    tagged = staged(fold_index(matrix.where(F.col("split") == "train"), n_splits, names, ts, step))
    began = time.perf_counter()
    models = fit_many(tagged, features, [(params, f) for f in range(1, n_splits + 1)], target, None, bins)
    seconds = (time.perf_counter() - began) / n_splits
    made = _predicted(models, tagged, target, [*names, FOLD]).select(*names, FOLD, "y_true", F.posexplode("all").alias("m", "y_pred"))
    fold, error = F.col("m") + 1, F.abs(F.col("y_true") - F.col("y_pred"))
    return made.withColumn("fold", fold).groupBy(*names, "fold").agg(
        F.avg(F.when(F.col(FOLD) == F.col("fold"), error)).alias("val_mae"), F.avg(F.when(F.col(FOLD) < F.col("fold"), error)).alias("train_mae"),
    ).select(*names, F.lit(name).alias("model"), "fold", "val_mae", "train_mae", F.lit(seconds).alias("fit_seconds"))


def fit_early_stopping(
    matrix: DataFrame,
    features: Sequence[str],
    params: TreeParams = TreeParams(),
    target: str = "y",
    val_fraction: float = 0.1,
    patience: int = 30,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    step: int = HOUR,
    bins: int = BINS,
) -> Boosted:
    """Fit on the training rows; the newest share of each series decides when to stop."""
    train = row_positions(matrix.where(F.col("split") == "train"), keys=keys, ts=ts, step=step, total="__n")
    held = F.col("pos") >= F.floor(F.col("__n") * (1 - val_fraction))
    return fit_many(staged(train.withColumn(FOLD, held.cast("int")).drop("pos", "__n")), features, [(params, 1)], target, patience, bins)[0]


def score(
    models: dict[str, Boosted],
    matrix: DataFrame,
    horizon: str = "h=1",
    target: str = "y",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
) -> DataFrame:
    """Forecasts of fitted models (which share features and bins) as rows of the prediction table."""
    names = as_keys(keys)
    made = _predicted(list(models.values()), matrix, target, [*names, ts])
    each = F.inline(F.array(*[F.struct(F.lit(n).alias("model"), F.get("all", F.lit(i)).alias("y_pred")) for i, n in enumerate(models)]))
    return made.select(*names, ts, "y_true", each).select(*names, "model", F.lit(horizon).alias("horizon"), ts, "y_true", "y_pred")


def importances(spark: SparkSession, model: Boosted, top: int | None = None) -> DataFrame:
    """``(feature, importance)``: each feature's mean gain per split, as a share of all features'."""
    total, number = np.zeros(len(model.features)), np.zeros(len(model.features))
    for tree in model.trees:
        split = tree.feature >= 0
        np.add.at(total, tree.feature[split], tree.gain[split])
        np.add.at(number, tree.feature[split], 1)
    mean = np.divide(total, number, out=np.zeros_like(total), where=number > 0)
    share = mean / mean.sum() if mean.sum() else mean
    table = spark.createDataFrame(list(zip(model.features, share.tolist())), "feature string, importance double")
    table = table.orderBy(F.desc("importance"), "feature")
    return table.limit(top) if top else table
