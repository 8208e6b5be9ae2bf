"""Hard-negative mining: for each anchor and positive, the best rows of other labels in a window of scores.

The windows of an anchor's positives overlap, and each ends at its positive's score. These upper limits
split the scores into disjoint slots. Each block of rows returns its best ``k`` candidates per anchor and
slot, blocks are combined per slot, and merging the slots from the lowest limit upwards answers all
windows: the best ``k`` at or below a limit are the slot's own first ``k``, filled up from the answer below.

Scores are exact inner products of the components as whole numbers, computed block against block: anchors
and rows are stored with a number each, dealt by its hash into blocks of about equal size, and a task holds one
block of either. What a block of rows returns is bounded by its anchors. A table whose scores might
pass 2^55 stops with an error.

Rows with a NULL label, a NULL vector, or a NULL or non-finite component take no part; a vector that is
shorter than another counts as filled up with zeros. NULL ids are no anchors, keep their label, and come
after all others in ties. Rows that repeat an id are rows of their own, as anchors, positives and negatives. A
negative score has an empty window. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattgrid.session import staged

K = 5
POSITIVES = 5
SCALE = 256
LEAST, MOST, WHOLE = 80, 100, 100  # the window of scores, in hundredths of the positive's score
ANCHOR_BLOCK = 1024
ROW_BLOCK = 4096
STEP = 64  # anchors scored at once

_FARTHEST = np.iinfo(np.int64).max


def prepared(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part; ``v`` are whole numbers."""
    number = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(whole)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), number.alias("v"))


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros; as floats where all scores are exact in these."""
    vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    length = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < length[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if bound < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**55:
        return a @ b.T
    raise ValueError("scores of these vectors might pass 2^55")


def _best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each (anchor, slot); ``row`` is the rank of the row among ties."""
    order = np.lexsort((row, -score, slot, anchor))
    a, s = anchor[order], slot[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1]))) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return order[place < k]


def _limits(anchors: pa.Table) -> np.ndarray:
    """Each anchor's limits, from the highest, filled up with the lowest possible number."""
    lists = anchors["limits"].to_pylist()
    out = np.full((len(lists), max(map(len, lists), default=0)), np.iinfo(np.int64).min)
    for row, limits in zip(out, lists):
        row[: len(limits)] = limits
    return out


def _scored(k: int, negatives: bool):
    """The best rows of one block for the anchors of another: for negatives per slot, else of the own label."""

    def best(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max()) for t in (anchors, rows))
            a, b = _matrix(anchors["v"], width), _matrix(rows["v"], width)
            label_a, label_b = anchors["label"].to_numpy(), rows["label"].to_numpy()
            at_a, at_b = anchors["at"].to_numpy(), rows["at"].to_numpy()
            ids = rows["vec_id"].combine_chunks()
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(_FARTHEST).to_numpy()
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((at_b, ids, nameless))] = np.arange(len(ids))
            limits = _limits(anchors) if negatives else None
            for first in range(0, len(a), STEP):
                some = slice(first, first + STEP)
                score = _products(a[some], b)
                same = label_a[some, None] == label_b[None, :]
                if negatives:
                    upper = limits[some]
                    lowest = np.where(upper == np.iinfo(np.int64).min, _FARTHEST, upper).min(axis=1)
                    # Not above the highest limit, and not below the window of the lowest one.
                    wanted = ~same & (score <= upper[:, :1]) & (score >= -(-LEAST * lowest[:, None] // WHOLE))
                    x, y = np.nonzero(wanted)
                    found = score[x, y]
                    slot = (found[:, None] <= upper[x]).sum(axis=1) - 1
                else:
                    x, y = np.nonzero(same & (at_a[some, None] != at_b[None, :]))
                    found, slot = score[x, y], np.zeros(len(x), np.int64)
                top = _best(x, slot, found, rank[y], k)
                out.append((at_a[first + x[top]], slot[top], found[top], y[top]))
        at, slot, score, row = (np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64) for c in range(4))
        return pa.table({
            "at": pa.array(at), "slot": pa.array(slot.astype(np.int32)), "score": pa.array(score),
            "vec_id": rows["vec_id"].combine_chunks().take(pa.array(row)), "row_at": rows["at"].combine_chunks().take(pa.array(row)),
        })

    return best


def _combined(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, k: int, negatives: bool) -> DataFrame:
    """``at, slot, score, vec_id``: the best ``k`` rows of each anchor and slot over all blocks."""
    a_blocks, r_blocks = -(-n_anchors // ANCHOR_BLOCK), -(-n_rows // ROW_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("at"), F.lit(max(n, 1))).cast("int")
    left = anchors.withColumns({"a": dealt(a_blocks), "r": every(r_blocks)})
    right = rows.withColumns({"r": dealt(r_blocks), "a": every(a_blocks)})
    grid = left.groupBy("a", "r").cogroup(right.groupBy("a", "r"))
    found = grid.applyInArrow(_scored(k, negatives), "at bigint, slot int, score bigint, vec_id bigint, row_at bigint")
    order = Window.partitionBy("at", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row_at")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("row_at")


def _numbered(rows: DataFrame) -> DataFrame:
    """Stored rows with a number ``at`` of their own."""
    return staged(rows.withColumn("at", F.monotonically_increasing_id()))


def mine(rows: DataFrame, is_anchor: Column, k: int = K, positives: int = POSITIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. ``rows`` has the columns
    ``vec_id, label, v`` of ``prepared``."""
    numbered = _numbered(rows.select("vec_id", "label", "v"))
    anchors = staged(numbered.where(is_anchor))
    n_rows, n_anchors = numbered.count(), anchors.count()
    chosen = staged(_combined(anchors, numbered, n_anchors, n_rows, positives, False))
    # Negative scores have an empty window, as 80 hundredths of them are above the whole.
    windows = chosen.where("score >= 0").groupBy("at").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    seeking = staged(anchors.join(windows, "at"))
    best = _combined(seeking, numbered, n_anchors, n_rows, k, True)
    per_anchor = best.groupBy("at").agg(F.collect_list(F.struct("slot", "place", "score", "vec_id")).alias("found"))

    # Answers of the slots from the lowest limit upwards: the slot's own rows, then those of the answer below.
    own = lambda slot: F.array_sort(F.filter("found", lambda c: c["slot"] == slot))
    slots = F.sequence(F.size("limits") - 1, F.lit(0), F.lit(-1))
    # The answer list grows at the front, so the answer of slot s ends up at position s.
    nothing = F.array().cast("array<array<struct<slot:int,place:int,score:bigint,vec_id:bigint>>>")
    below = lambda acc: F.coalesce(F.get(acc, F.lit(0)), F.array().cast("array<struct<slot:int,place:int,score:bigint,vec_id:bigint>>"))
    answers = F.reduce(slots, nothing, lambda acc, s: F.concat(F.array(F.slice(F.concat(own(s), below(acc)), 1, k)), acc))
    answered = per_anchor.join(seeking.select("at", "limits", F.col("vec_id").alias("anchor_id")), "at").withColumn("answers", answers)
    pairs = chosen.where("score >= 0").select("at", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    answer = F.get("answers", F.array_position("limits", F.col("positive_score")).cast("int") - 1)
    inside = F.filter(answer, lambda c: (WHOLE * c["score"] >= LEAST * F.col("positive_score")) & (WHOLE * c["score"] <= MOST * F.col("positive_score")))
    out = pairs.join(answered, "at").select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("rank", "n"))
    return out.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"),
    )
