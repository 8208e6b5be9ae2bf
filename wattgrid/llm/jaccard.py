"""N-gram Jaccard join: all pairs of texts whose shingle sets are similar, and the groups they form.

A size-aware heavy-light join on sets of hashed five-word shingles. Small sets (size below a boundary
that the measured costs choose) enumerate their fixed-size subsets: two sets that need an overlap of c
share a subset of c members. Large sets are scanned through inverted lists of their prefix: with all
members in one global order, two similar sets share a member among the first ``n - ceil(3 n / 4) + 1``
of each. The order puts rare members first, by a sketch of fixed size that counts all shingles of all
texts, so that a passage many texts share stays out of the lists of texts that only quote it.

Equal sets are one class (its member with the smallest id stands for it). Within the lists a few leaders
are compared with everyone first; classes that this connects need no further comparison, and all other
pairs of a list are compared if sizes and parity bitmaps (a lower bound of the difference; large sets have
a second one that grows with them) allow a link.
That yields the components. Every link lies inside one, so all links follow from comparing the full sets
of each component with one another, in blocks; ``groups`` counts them and ``pairs`` lists them.

A text with fewer than five words is one shingle; a NULL, empty or wordless text has an empty set and
links with nothing. Documents are told apart by ``doc_id``: rows with a NULL id form one document, and
rows that share an id are members of all their classes at once. Extra columns are ignored (``keep_one``
keeps them).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattgrid.llm import components
from wattgrid.session import discard, staged

WORDS = 5
SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 16
BITMAP_BITS = 1024
LONGS = BITMAP_BITS // 64
WIDE_FROM = 512
LEAST_BOUNDARY, MOST_BOUNDARY = 2, 14
LEADERS = 4
STAR_ROUNDS = 2
FILTER_BITS = 20
BLOCK_SETS, BLOCK_MEMBERS = 256, 1 << 20
COLUMNS = 1 << 13

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Distinct hashed shingles of a text. Holds the powers that prefix sums of bytes need."""

    def __init__(self):
        self.grow(1 << 14)

    def grow(self, size: int) -> None:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        ones = np.ones(size, np.uint64)
        self.power, self.inverse = (np.cumprod(np.concatenate([ones[:1], ones[1:] * b])) for b in (_BASE, inverse))

    def _word_hashes(self, raw: bytes) -> np.ndarray:
        data = np.frombuffer(raw, np.uint8)
        if len(data) >= len(self.power):
            self.grow(2 * len(data))
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * self.power[: len(data)])])
        return _mixed((sums[ends] - sums[starts]) * self.inverse[starts])

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles of UTF-8 text; empty without words."""
        raw = (text or b"").lower()  # of bytes: A-Z only
        if len(raw) <= _PIECE:
            words = self._word_hashes(raw)
        else:  # cut at white space, so that the tables stay small
            parts, at = [], 0
            while at < len(raw):
                to = min(at + _PIECE, len(raw))
                while to < len(raw) and not _SPACE[raw[to]]:
                    to += 1
                parts.append(self._word_hashes(raw[at:to]))
                at = to
            words = np.concatenate(parts)
        size = min(WORDS, len(words))
        if not size:
            return np.zeros(0, np.uint64)
        h = np.full(len(words) - size + 1, size, np.uint64)
        for j in range(size):
            h = _mixed(h * np.uint64(0x2545F4914F6CDD1D) + words[j : len(words) - size + 1 + j])
        return np.unique(h)


def least_overlap(n: int, m: int) -> int:
    """Members that sets of sizes n and m must share: 100 * common >= 75 * union."""
    return -(-3 * (n + m) // 7)


def subset_sizes(n: int, boundary: int) -> list[int]:
    """The overlaps that a small set of size n may need with another small set."""
    return sorted({least_overlap(n, m) for m in range(1, boundary) if 4 * min(n, m) >= 3 * max(n, m)})


def prefix_length(n: int) -> int:
    return n - -(-3 * n // 4) + 1


def keys(shingles: np.ndarray, level: np.ndarray, boundary: int) -> np.ndarray:
    """The list keys of a set: subset hashes of a small set, prefix members of a large one. Small sets
    that may be similar to a large one have both."""
    n, found = len(shingles), []
    if 0 < n < boundary:
        for size in subset_sizes(n, boundary):
            chosen = shingles[np.array(list(combinations(range(n), size)))]
            found.append(_mixed(_mixed(chosen, 77).sum(axis=1, dtype=np.uint64), 1000 + size))
    if n and 4 * n >= 3 * boundary:
        order = np.lexsort((shingles, level[shingles >> np.uint64(64 - SKETCH_BITS)]))
        found.append(shingles[order[: prefix_length(n)]])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def identity(shingles: np.ndarray) -> tuple[int, int]:
    """96 bits that equal sets share."""
    a, b = ((int(_mixed(shingles, salt).sum(dtype=np.uint64)) + len(shingles) * int(_BASE)) % (1 << 64) for salt in (11, 13))
    return a - (1 << 64 if a >= 1 << 63 else 0), b >> 32


def parity(shingles: np.ndarray) -> list[int]:
    """Bit k is the parity of the number of members that hash to k. Two sets differ in at least as many
    members as their bitmaps differ in bits."""
    odd = np.bincount((_mixed(shingles, 17) >> np.uint64(64 - 10)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def wide_parity(shingles: np.ndarray) -> list[int] | None:
    """The same kind of bitmap with two to four bits per member, for sets that fill the fixed one; None for
    others. Half as wide a bitmap is the first half XOR the second."""
    if len(shingles) <= WIDE_FROM:
        return None
    width = 1 << (2 * len(shingles) - 1).bit_length()
    odd = np.bincount((_mixed(shingles, 19) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("text"))


def sets(documents: DataFrame) -> DataFrame:
    """``id, n, a, b, bits, wide`` for each row: set size, set identity and parity bitmaps. On the same pass each
    task counts its shingles by 2^SKETCH_BITS buckets; rows ``block, counts`` hold that, all else NULL."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, totals = Shingler(), np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            found = [shingler(t.as_py()) for t in batch["text"]]
            for s in found:
                np.add.at(totals, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            marks = [identity(s) for s in found]
            columns = [
                [len(s) for s in found], [m[0] for m in marks], [m[1] for m in marks],
                [parity(s) for s in found], [wide_parity(s) for s in found],
            ]
            columns += [[None] * len(found)] * 2
            yield pa.record_batch([batch["id"], *(pa.array(c, kind) for c, kind in zip(columns, _SETS.types[1:]))], schema=_SETS)
        for at in range(0, len(totals), SKETCH_BLOCK):
            packed = zlib.compress(totals[at : at + SKETCH_BLOCK].astype("<u4").tobytes(), 1)
            columns = [*[None] * (len(_SETS) - 2), at // SKETCH_BLOCK, packed]
            yield pa.record_batch([pa.array([c], kind) for c, kind in zip(columns, _SETS.types)], schema=_SETS)

    kinds = "id bigint, n bigint, a bigint, b bigint, bits array<bigint>, wide array<bigint>, block bigint, counts binary"
    return _rows(documents).mapInArrow(describe, kinds)


_SETS = pa.schema([
    *((c, pa.int64()) for c in ("id", "n", "a", "b")), *((c, pa.list_(pa.int64())) for c in ("bits", "wide")), ("block", pa.int64()), ("counts", pa.binary()),
])


def rarity(counted: DataFrame) -> np.ndarray:
    """A level for each of 2^SKETCH_BITS buckets, from rows ``block, counts``: how often shingles of all texts fall
    into it, in steps of a factor of four above the average."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(zlib.decompress(c.as_py()), "<u4").astype("<i8") for batch in batches for c in batch["counts"])
        yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([total.tobytes()], pa.binary())], names=["block", "counts"])

    # Blocks of equal number are added as they stream by; the result has the size of one sketch.
    blocks = counted.groupBy("block").applyInArrow(add, "block bigint, counts binary").collect()
    totals = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in blocks:
        at = row["block"] * SKETCH_BLOCK
        totals[at : at + SKETCH_BLOCK] = np.frombuffer(row["counts"], "<i8")
    base = max(totals.mean(), 1.0)
    return np.clip(np.ceil(np.log2(np.maximum(totals / (1.5 * base), 1)) / 2), 0, 20).astype(np.uint8)


def cheapest_boundary(sizes: dict[int, int]) -> int:
    """The boundary between small and large sets with the fewest list entries; ``sizes`` counts sets by
    size, up to MOST_BOUNDARY * 4 / 3."""
    def entries(x: int) -> int:
        small = sum(c * sum(comb(n, k) for k in subset_sizes(n, x)) for n, c in sizes.items() if 0 < n < x)
        return small + sum(c * prefix_length(n) for n, c in sizes.items() if 4 * n >= 3 * x)

    return min(range(LEAST_BOUNDARY, MOST_BOUNDARY + 1), key=lambda x: (entries(x), x))


def _list_rows(documents: DataFrame, level: np.ndarray, boundary: int) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(level)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for lot in range(0, batch.num_rows, 256):
                found = [shingler(t.as_py()) for t in batch["text"].slice(lot, 256)]
                each = [keys(s, shared.value, boundary) for s in found]
                marks = np.array([identity(s)[0] for s in found], np.int64)
                columns = [np.concatenate(each).view(np.int64), np.repeat(marks, [len(k) for k in each])]
                yield pa.record_batch([pa.array(c) for c in columns], names=["key", "a"])

    return _rows(documents).select("text").mapInArrow(listed, "key bigint, a bigint")


def _classes(described: DataFrame) -> DataFrame:
    """``a, b, v, n, bits, wide``: the classes of equal sets by their smallest id. NULL ids count as one
    document below all others."""
    held = described.where("n > 0").select("a", "b", "n", "bits", "wide", F.coalesce("id", F.lit(NO_ID)).alias("id"))
    return held.groupBy("a", "b").agg(F.min("id").alias("v"), *(F.first(c).alias(c) for c in ("n", "bits", "wide")))


NO_ID = -(1 << 63)


def _sizes_fit(n: Column, m: Column) -> Column:
    return 4 * F.least(n, m) >= 3 * F.greatest(n, m)


def _bitmaps_fit(x: Column, y: Column, n: Column, m: Column) -> Column:
    """The bitmaps leave a similarity of 0.75 possible."""
    differing = sum((F.bit_count(F.get(x, k).bitwiseXOR(F.get(y, k))) for k in range(LONGS)), F.lit(0))
    return 7 * differing <= n + m


def _sifted(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``x, y`` that the wide bitmaps leave possible. Where a set has none, its pairs stay."""
    wide = classes.where("wide IS NOT NULL").select("v", "n", "wide")
    met = pairs
    for side in ("y", "x"):
        met = met.join(wide.select(F.col("v").alias(side), F.col("n").alias(f"{side}_n"), F.col("wide").alias(f"{side}_wide")), side, "left")
    longs = F.least(F.size("x_wide"), F.size("y_wide"))
    left, right = (_halved(F.col(f"{side}_wide"), longs) for side in ("x", "y"))
    differing = F.aggregate(F.zip_with(left, right, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, bits: total + bits)
    return met.where(F.coalesce(7 * differing <= F.col("x_n") + F.col("y_n"), F.lit(True))).select("x", "y")


def _halved(bits: Column, longs: Column) -> Column:
    """A wide bitmap at the given number of longs: its own, or half of that."""
    halves = (F.slice(bits, 1, longs), F.slice(bits, longs + 1, longs))
    return F.when(F.size(bits) > longs, F.zip_with(*halves, lambda p, q: p.bitwiseXOR(q))).otherwise(bits)


def _needed_filter(ids: DataFrame) -> np.ndarray:
    """A bit for each of 2^FILTER_BITS buckets of the class ids ``v``; bounded by its size."""
    buckets = ids.select(F.pmod(F.xxhash64("v"), F.lit(1 << FILTER_BITS)).alias("k")).distinct()
    held = np.zeros(1 << FILTER_BITS, bool)
    held[buckets.toPandas()["k"].to_numpy(np.int64)] = True
    return np.packbits(held)


def _bucketed(documents: DataFrame) -> DataFrame:
    """``v, k, text``: rows by id, with the id's bucket in the filter."""
    rows = _rows(documents).select(F.coalesce("id", F.lit(NO_ID)).alias("v"), "text")
    return rows.select("v", F.pmod(F.xxhash64("v"), F.lit(1 << FILTER_BITS)).alias("k"), "text")


def _verified(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b``: the pairs ``x, y`` of class ids whose full sets are similar enough, stored. ``pairs`` must be a
    stored table of distinct pairs. The set of ``y`` travels to ``x``, so many pairs of one x are cheap."""
    context = documents.sparkSession.sparkContext
    held = context.broadcast(_needed_filter(pairs.select(F.explode(F.array("x", "y")).alias("v"))))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, needed = Shingler(), np.unpackbits(held.value).astype(bool)
        for batch in batches:
            chosen = np.flatnonzero(needed[batch["k"].to_numpy()])
            found = [shingler(batch["text"][i].as_py()) for i in chosen.tolist()]
            yield pa.record_batch([batch["v"].take(pa.array(chosen)), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["v", "members"])

    full = staged(_bucketed(documents).mapInArrow(members, "v bigint, members array<bigint>"))
    met = pairs.join(full.select(F.col("v").alias("y"), F.col("members").alias("my")), "y")
    met = met.join(full.select(F.col("v").alias("x"), F.col("members").alias("mx")), "x")
    common = F.size(F.array_intersect("mx", "my"))
    similar = 175 * common >= 75 * (F.size("mx") + F.size("my"))
    checked = staged(met.where(similar).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    discard(full)
    return checked


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Attach ``label``, the component of ``v`` by the links found so far; stored."""
    found = components.labels(links).select(F.col("node").alias("v"), "label")
    labelled = staged(rows.join(found, "v", "left").withColumn("label", F.coalesce("label", "v")))
    discard(found)
    return labelled


def links(documents: DataFrame, described: DataFrame, level: np.ndarray) -> DataFrame:
    """``a, b``: links between class ids that connect the same components as all links do. ``described``
    are the stored rows of ``sets``, ``level`` their ``rarity``."""
    sizes = described.where(F.col("n").between(1, ceil(MOST_BOUNDARY * 4 / 3))).groupBy("n").count().collect()
    boundary = cheapest_boundary({r["n"]: r["count"] for r in sizes})
    classes = staged(_classes(described))
    # One shuffle by key finds the lists with different classes; a list streams through its task. Half of the
    # identity names the class here: classes that share it are listed together and compared like others.
    whole = Window.partitionBy("key")
    listed = _list_rows(documents, level, boundary)
    listed = listed.select("key", "a", F.min("a").over(whole).alias("low"), F.max("a").over(whole).alias("high"))
    shared = listed.where("low <> high").select("key", "a").distinct()
    lists = staged(shared.join(classes.select("a", "v", "n"), "a").select("key", "v", "n"))
    bits = classes.select("v", "n", "bits")
    found = None
    for turn in range(STAR_ROUNDS):
        rows = _unsettled(lists, found)
        drawn = F.xxhash64("v", F.pmod("key", F.lit(LEADERS)), F.lit(turn))
        leaders = rows.groupBy("key").agg(F.min(F.struct(drawn.alias("d"), "v", "label", "n")).alias("lead"))
        met = rows.join(leaders, "key").where((F.col("label") != F.col("lead.label")) & _sizes_fit(F.col("n"), F.col("lead.n")))
        pairs = met.select(F.col("lead.v").alias("x"), F.col("v").alias("y")).distinct()
        pairs = pairs.join(_renamed(bits, "x"), "x").join(_renamed(bits, "y"), "y")
        found = _extended(documents, classes, found, pairs.where(_bitmaps_fit(F.col("x_bits"), F.col("y_bits"), F.col("x_n"), F.col("y_n"))))
        if turn:
            discard(rows)
    rest = _unsettled(lists, found).join(bits.drop("n"), "v")
    left, right = (rest.select(*[F.col(c).alias(f"{side}_{c}") for c in ("key", "label", "n", "bits")], F.col("v").alias(side)) for side in ("x", "y"))
    fit = _sizes_fit(F.col("x_n"), F.col("y_n")) & _bitmaps_fit(F.col("x_bits"), F.col("y_bits"), F.col("x_n"), F.col("y_n"))
    apart = (F.col("x_key") == F.col("y_key")) & (F.col("x") < F.col("y")) & (F.col("x_label") != F.col("y_label"))
    connected = _extended(documents, classes, found, left.join(right, apart & fit))
    for stage in (rest, lists, classes):
        discard(stage)
    return connected


def _renamed(bits: DataFrame, side: str) -> DataFrame:
    return bits.select(F.col("v").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits"))


def _unsettled(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """``key, v, n, label``: the lists whose classes do not all belong to one component yet."""
    rows = lists.withColumn("label", F.col("v")) if found is None else _labelled(lists, found)
    several = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    return rows.join(several, "key", "left_semi")


def _extended(documents: DataFrame, classes: DataFrame, found: DataFrame | None, met: DataFrame) -> DataFrame:
    """The links found so far and those among the pairs ``x, y``, each checked once. Whole sets travel only
    for pairs that all bitmaps leave possible."""
    once = met.select("x", "y", F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")).dropDuplicates(["low", "high"])
    candidates = staged(_sifted(once.select("x", "y"), classes))
    more = _verified(documents, candidates)
    discard(candidates)
    if found is None:
        return more
    both = staged(found.unionByName(more))
    discard(found)
    discard(more)
    return both


def _blocks(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``v, a, b, label, block, blocks`` for each class (``a, b, v, n``) that has a link: its component, and
    one of the blocks among which the sets of a component are dealt."""
    held = classes.join(components.labels(found).select(F.col("node").alias("v"), "label"), "v")
    shares = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_MEMBERS)).cast("int")
    dealt = held.join(held.groupBy("label").agg(shares.alias("blocks")), "label")
    return dealt.select("v", "a", "b", "label", F.pmod(F.xxhash64("a", "b"), "blocks").cast("int").alias("block"), "blocks")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each set on the left shares with each on the right."""
    count = [len(s) for s in (*left, *right)]
    owner, members = np.repeat(np.arange(len(count)), count), np.concatenate([*left, *right])
    order = np.argsort(members, kind="stable")
    owner, members = owner[order], members[order]
    fresh = np.concatenate([[True], members[1:] != members[:-1]])
    held = np.diff(np.append(np.flatnonzero(fresh), len(members)))
    several = np.repeat(held > 1, held)  # a member of one set is not shared
    owner, column = owner[several], np.cumsum(fresh[several]) - 1
    common = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        dense = np.zeros((len(count), int(column[hi - 1]) - at + 1), np.float32)
        dense[owner[lo:hi], column[lo:hi] - at] = 1
        common += np.rint(dense[: len(left)] @ dense[len(left) :].T).astype(np.int64)
    return common


def _compared(documents: DataFrame, blocks: DataFrame, counts: bool) -> DataFrame:
    """All links between different sets of one component, ``blocks`` being stored. With ``counts``, as
    ``a, b, n_links`` for each class and pair of blocks, else as ``x, y`` of class ids."""
    held = documents.sparkSession.sparkContext.broadcast(_needed_filter(blocks))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.unpackbits(held.value).astype(bool)
        for batch in batches:
            yield batch.select(["v", "text"]).filter(pa.array(needed[batch["k"].to_numpy()]))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for lot in range(0, batch.num_rows, 64):
                part = batch.slice(lot, 64)
                found = [shingler(t.as_py()) for t in part["text"]]
                own = list(zip(part["a"].to_pylist(), part["b"].to_pylist()))
                same = [i for i, s in enumerate(found) if identity(s) == own[i]]  # rows of one id may be of several classes
                sets = pa.array([found[i].view(np.int64) for i in same], pa.list_(pa.int64()))
                rest = part.drop_columns(["text"]).take(pa.array(same, pa.int64()))
                yield pa.record_batch([*rest.columns, sets], names=[*rest.schema.names, "members"])

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, sides = key[1].as_py(), key[2].as_py(), {}
        for batch in batches:
            for i, (block, *own) in enumerate(zip(*(batch[c].to_pylist() for c in ("block", "v", "a", "b")))):
                sides.setdefault(block, {})[tuple(own)] = batch["members"][i].values.to_numpy().view(np.uint64)
        left, right = (list(sides.get(block, {}).items()) for block in (low, high))
        if not left or not right:
            return
        n, m = (np.array([len(s) for _, s in side]) for side in (left, right))
        similar = 175 * overlaps([s for _, s in left], [s for _, s in right]) >= 75 * (n[:, None] + m)
        if low == high:
            np.fill_diagonal(similar, False)
        if counts:
            ends = [(left, similar.sum(axis=1))] + [(right, similar.sum(axis=0))] * (low != high)
            columns = [[own[k] for side, _ in ends for own, _ in side] for k in (1, 2)] + [np.concatenate([c for _, c in ends])]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n_links"])
        else:
            x, y = np.nonzero(np.triu(similar) if low == high else similar)
            ids = [np.array([own[0] for own, _ in side], np.int64)[at] for side, at in ((left, x), (right, y))]
            yield pa.record_batch([pa.array(np.minimum(*ids)), pa.array(np.maximum(*ids))], names=["x", "y"])

    texts = _bucketed(documents).mapInArrow(chosen, "v bigint, text binary")
    once = texts.join(blocks, "v").distinct()
    sets = once.mapInArrow(dealt, "v bigint, a bigint, b bigint, label bigint, block int, blocks int, members array<bigint>")
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("label", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "v", "a", "b", "members")
    return met.groupBy("label", "low", "high").applyInArrow(compare, "a bigint, b bigint, n_links bigint" if counts else "x bigint, y bigint")


def _joined(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored sets of all rows, the connecting links, and ``v, a, b, n`` of each class."""
    made = staged(sets(documents))
    described = made.where("block IS NULL").drop("block", "counts")
    level = rarity(made.where("block IS NOT NULL").select("block", "counts"))
    return described, links(documents, described, level), _classes(described).select("v", "a", "b", "n")


def pairs(documents: DataFrame) -> DataFrame:
    """``doc_x, doc_y``: all links between different sets, each set named by its smallest ``doc_id``;
    the lower id first."""
    _, found, classes = _joined(documents)
    met = _compared(documents, staged(_blocks(classes, found)), counts=False)
    return met.select(*(F.nullif(side, F.lit(NO_ID)).alias(f"doc_{side}") for side in ("x", "y")))


def _grouped(described: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, a, b`` for each row."""
    ids = described.where("n > 0").select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "a", "b")
    # Rows that share an id connect their classes.
    repeated = ids.join(classes, ["a", "b"]).select(F.col("id").alias("a"), F.col("v").alias("b")).where("a <> b")
    several = repeated.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
    bridges = several.where("low <> high").select("a", F.col("low").alias("b")).unionByName(several.where("low <> high").select("a", F.col("high").alias("b")))
    labels = components.labels(found.unionByName(bridges)).select(F.col("node").alias("v"), "label")
    by_class = classes.join(labels, "v", "left").select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.coalesce("label", "v").alias("component"))
    rows = described.join(by_class, (F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb")) & (F.col("n") > 0), "left")
    own = F.coalesce("component", F.coalesce("id", F.lit(NO_ID)))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(own, F.lit(NO_ID)).alias("component_id"), "a", "b")


def groups(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for each document row. ``component_id`` is the smallest
    ``doc_id`` that links reach, the row's own included; ``n_links`` counts the different sets that the
    row's set is similar to."""
    described, found, classes = _joined(documents)
    blocks = staged(_blocks(classes, found))
    counted = staged(_compared(documents, blocks, counts=True).groupBy("a", "b").agg(F.sum("n_links").alias("n_links")))
    discard(blocks)
    rows = _grouped(described, found, classes).join(counted, ["a", "b"], "left")
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group, with all its columns; documents without
    words stay. Rows that share the kept id are one document and stay together."""
    found = _grouped(*_joined(documents)).where((F.col("n_shingles") > 0) & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = found.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("gone_id")).distinct()
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    kept = rows.join(gone, F.coalesce(F.col("row.doc_id").cast("bigint"), F.lit(NO_ID)) == F.col("gone_id"), "left_anti")
    return kept.select("row.*")
