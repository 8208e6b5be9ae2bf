"""Suffix-array dedup: remove every byte that a repeated 400-byte string covers, over the whole corpus.

Equal strings must meet in one shard before suffixes are sorted. Each string selects an anchor inside
itself: its 32 bytes with the smallest hash (the leftmost of equals). The strings of an anchor that have
it within the same block of offsets also share a core around the anchor; the core's hash names the
shard key. Keys that occur once are left out. The strings of a key form a short context; equal contexts
are merged and counted, and the different contexts of a key are sorted by one suffix array, built by
induced sorting; permuted common prefixes of 400 and more, or a count of two and more, mark repeats.
Keys with very many different contexts are dealt anew by finer blocks of offsets, at the finest by the
string itself, so no shard grows with the number of copies.

A NULL or empty text has no bytes. Texts are handled as UTF-8; matches never cross documents. Rows are
told apart by ``doc_id`` and text; a repeated row repeats all its strings. Extra columns are ignored
(``remove`` keeps them; it cuts at character boundaries, so a character that is removed in part goes).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattgrid.llm import suffix_array
from wattgrid.session import discard, staged

LENGTH = 400
GRAM = 32
SPLITS = (2, 16)
MOST_CONTEXTS = 4096
SHARD_BYTES = 1 << 20
SEGMENT = 1 << 19
FILTER_BITS = 20

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Anchors:
    """Finds the runs of strings that share an anchor and a block of offsets."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.offsets = length, gram, length - gram + 1
        size = SEGMENT + length + 1
        steps = np.ones(size, np.uint64)
        steps[1:] = _BASE
        self.power = np.cumprod(steps)
        steps[1:] = _INVERSE
        self.inverse = np.cumprod(steps)

    def _sums(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * self.power[: len(data)])])

    def _selected(self, sums: np.ndarray) -> np.ndarray:
        """For each string its anchor's place: the smallest hash among its grams, the leftmost first."""
        last = len(sums) - self.gram
        grams = _mixed((sums[self.gram :] - sums[:last]) * self.inverse[:last])
        marked = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(last, dtype=np.uint64)
        w = self.offsets
        padded = np.full(-(-last // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:last] = marked
        blocks = padded.reshape(-1, w)
        upto = np.minimum.accumulate(blocks, axis=1).ravel()
        since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(since[: last - w + 1], upto[w - 1 : last])
        return (least & np.uint64((1 << 20) - 1)).astype(np.int64)

    def _runs(self, sums: np.ndarray, anchor: np.ndarray, first: np.ndarray, splits: int) -> tuple[np.ndarray, ...]:
        """Runs of equal anchor and block over the strings at ``first``: key, start, count."""
        width = -(-self.offsets // splits)
        block = (anchor - first) // width
        edge = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]) | (first[1:] != first[:-1] + 1)))
        count = np.diff(np.append(edge, len(first)))
        a, j = anchor[edge], block[edge]
        low = a - j * width
        high = a - np.minimum((j + 1) * width - 1, self.offsets - 1) + self.length
        core = (sums[high] - sums[low]) * self.inverse[low]
        return _mixed(core + j.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(splits)), first[edge], count

    def of_text(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, start and number of strings for each run of a text."""
        data, found = np.frombuffer(raw, np.uint8), []
        for at in range(0, max(len(data) - self.length + 1, 0), SEGMENT):
            sums = self._sums(data[at : at + SEGMENT + self.length - 1])
            anchor = self._selected(sums)
            key, start, count = self._runs(sums, anchor, np.arange(len(anchor)), SPLITS[0])
            found.append((key, start + at, count))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def of_context(self, raw: bytes, splits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for a context, with finer blocks of offsets."""
        sums = self._sums(np.frombuffer(raw, np.uint8))
        anchor = self._selected(sums)
        return self._runs(sums, anchor, np.arange(len(anchor)), splits)


def _rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text).alias("t"), text.cast("binary").alias("raw"))


def _same(left: str, right: str):
    return F.col(f"{left}_id").eqNullSafe(F.col(f"{right}_id")) & (F.col(f"{left}_t") == F.col(f"{right}_t"))


def _bucket():
    return F.pmod(F.xxhash64("id", "t"), F.lit(1 << FILTER_BITS))


def _held(rows: DataFrame) -> np.ndarray:
    """A bit for each of 2^FILTER_BITS buckets of rows ``id, t``: a filter of fixed size."""
    buckets = rows.select(_bucket().alias("k")).distinct().toPandas()["k"].to_numpy(np.int64)
    held = np.zeros(1 << FILTER_BITS, bool)
    held[buckets] = True
    return np.packbits(held)


def _possibly(documents: DataFrame, rows: DataFrame, wanted: bool = True) -> DataFrame:
    """Document rows whose bucket is (not) held by ``rows``; decided where the rows are read."""
    shared = documents.sparkSession.sparkContext.broadcast(_held(rows))

    @F.arrow_udf("boolean")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = np.unpackbits(shared.value).astype(bool)
        for k in batches:
            yield pa.array(bits[k.to_numpy(zero_copy_only=False)])

    kept = held(_bucket())
    return _rows(documents).where(kept if wanted else ~kept)


def _keys(documents: DataFrame) -> DataFrame:
    """``key, id, t, m``: the different keys of each document row and how often each occurs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            for lot in range(0, batch.num_rows, 1024):
                part = batch.slice(lot, 1024)
                found = [np.unique(anchors.of_text(r.as_py())[0], return_counts=True) for r in part["raw"]]
                row = pa.array(np.repeat(np.arange(len(found)), [len(k) for k, _ in found]))
                key, times = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                yield pa.record_batch([pa.array(key.view(np.int64)), part["id"].take(row), part["t"].take(row), pa.array(times)], names=["key", "id", "t", "m"])

    return _rows(documents).where(F.octet_length("raw") >= LENGTH).mapInArrow(find, "key bigint, id bigint, t bigint, m bigint")


_CONTEXT_DDL = "key bigint, id bigint, t bigint, start bigint, n bigint, context binary"
_CONTEXT_NAMES = ["key", "id", "t", "start", "n", "context"]


def _contexts(documents: DataFrame) -> DataFrame:
    """Runs whose key occurs more than once, with their bytes."""
    # Stored: found once, read for the counts and for the documents that hold a repeated one.
    keys = staged(_keys(documents))
    # Stored, so that the adaptive planner may split a key that very many documents hold.
    repeated = staged(keys.groupBy("key").agg(F.sum("m").alias("n")).where("n > 1").select("key"))
    wanted = staged(keys.select("key", "id", "t").join(repeated, "key").groupBy("id", "t").agg(F.collect_set("key").alias("keys")))
    discard(keys)
    texts = _possibly(documents, wanted)
    left = texts.select(F.col("id").alias("l_id"), F.col("t").alias("l_t"), "raw")
    right = wanted.select(F.col("id").alias("r_id"), F.col("t").alias("r_t"), "keys")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch["raw"][i].as_py()
                key, start, count = anchors.of_text(raw)
                chosen = np.isin(key.view(np.int64), batch["keys"][i].values.to_numpy())
                key, start, count = key[chosen].view(np.int64), start[chosen], count[chosen]
                bytes_ = [raw[s : s + n + LENGTH - 1] for s, n in zip(start.tolist(), count.tolist())]
                row = pa.array(np.full(len(key), i))
                yield pa.record_batch([pa.array(key), batch["l_id"].take(row), batch["l_t"].take(row), pa.array(start), pa.array(count), pa.array(bytes_, pa.binary())], names=_CONTEXT_NAMES)

    joined = left.join(right, _same("l", "r")).select("l_id", "l_t", "raw", "keys")
    return _marked(joined.mapInArrow(cut, _CONTEXT_DDL))


def _marked(contexts: DataFrame) -> DataFrame:
    """Add the 128-bit identity ``a, b`` of the context."""
    return contexts.withColumn("a", F.xxhash64("context")).withColumn("b", F.xxhash64(F.lit(1), "context"))


def _finer(contexts: DataFrame, splits: int) -> DataFrame:
    """The same strings under keys of finer blocks; keys that occur once are left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            for i in range(batch.num_rows):
                raw, at = batch["context"][i].as_py(), batch["start"][i].as_py()
                key, start, count = anchors.of_context(raw, splits)
                bytes_ = [raw[s : s + n + LENGTH - 1] for s, n in zip(start.tolist(), count.tolist())]
                row = pa.array(np.full(len(key), i))
                yield pa.record_batch([pa.array(key.view(np.int64)), batch["id"].take(row), batch["t"].take(row), pa.array(start + at), pa.array(count), pa.array(bytes_, pa.binary())], names=_CONTEXT_NAMES)

    found = contexts.select("id", "t", "start", "context").mapInArrow(cut, _CONTEXT_DDL)
    repeated = found.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    return _marked(found.join(repeated, "key"))


def _shards(contexts: DataFrame, most: int) -> DataFrame:
    """Deal keys with more than ``most`` different contexts anew, until every key is small. The result is stored."""
    parts, rest = [], staged(contexts)
    for splits in (*SPLITS[1:], LENGTH - GRAM + 1):
        distinct = rest.groupBy("key", "a", "b").agg(F.lit(1).alias("one"))
        large = staged(distinct.groupBy("key").agg(F.count("one").alias("m")).where(F.col("m") > most).select("key"))
        if large.isEmpty():
            break
        parts.append(rest.join(large, "key", "left_anti"))
        rest = staged(_finer(rest.join(large, "key", "left_semi"), splits))
    if not parts:
        return rest
    out = rest
    for part in parts:
        out = out.unionByName(part)
    whole = staged(out)
    discard(out)
    return whole


def repeats(contexts: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """For the different contexts of some keys: which of their strings occur again, in them or in a copy."""
    sizes = np.array([len(c) for c in contexts])
    text = np.ones(int(sizes.sum()) + len(contexts) + 1, np.uint16)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    for c, at in zip(contexts, starts):
        text[at : at + len(c)] = np.frombuffer(c, np.uint8).astype(np.uint16) + 2
    text[-1] = 0
    array = suffix_array.suffix_array(text, 258)
    strings = np.concatenate([np.arange(at, at + n - LENGTH + 1) for at, n in zip(starts, sizes)])
    shared = suffix_array.common_prefixes(text, array, strings, LENGTH)
    each = np.split(shared, np.cumsum(sizes - LENGTH + 1)[:-1])
    return [s | (n > 1) for s, n in zip(each, counts)]


def _runs_of(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"low": int(a), "high": int(b)} for a, b in zip(edges[::2], edges[1::2])]


_RUNS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole keys in lots of about SHARD_BYTES, one suffix array each. Rows come sorted by key."""
    lot, size, last = [], 0, None

    def solve() -> pa.RecordBatch:
        found = repeats([r["context"] for r in lot], [r["copies"] for r in lot]) if lot else []
        runs = [_runs_of(m) for m in found]
        return pa.record_batch([pa.array([r[c] for r in lot], pa.int64()) for c in ("key", "a", "b")] + [pa.array(runs, _RUNS)], names=["key", "a", "b", "runs"])

    for batch in batches:
        for row in batch.to_pylist():
            if size >= SHARD_BYTES and row["key"] != last:
                yield solve()
                lot, size = [], 0
            lot.append(row)
            size, last = size + len(row["context"]), row["key"]
    yield solve()


def covered(documents: DataFrame, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """``id, t, spans``: for each document text with repeats, the byte ranges (low, high) they cover."""
    rows = _shards(_contexts(documents), most_contexts)
    distinct = rows.groupBy("key", "a", "b").agg(F.first("context").alias("context"), F.count("*").alias("copies"))
    ordered = distinct.repartition("key").sortWithinPartitions("key", "a", "b")
    found = ordered.mapInArrow(_sorted_shards, "key bigint, a bigint, b bigint, runs array<struct<low:bigint,high:bigint>>")
    found = staged(found.where(F.size("runs") > 0))
    spans = rows.select("key", "a", "b", "id", "t", "start").join(found, ["key", "a", "b"]).select("id", "t", "start", F.explode("runs").alias("r"))
    spans = spans.select("id", "t", F.struct((F.col("start") + F.col("r.low")).alias("low"), (F.col("start") + F.col("r.high") + LENGTH - 1).alias("high")).alias("s"))
    whole = staged(spans.groupBy("id", "t").agg(F.array_sort(F.collect_set("s")).alias("spans")))
    discard(spans)
    return whole


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for s in spans:
        if runs and s["low"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s["high"])
        else:
            runs.append([s["low"], s["high"]])
    return [tuple(r) for r in runs]


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for r in runs for e in r), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def summary(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each document row."""
    spans = covered(documents)
    kind = pa.struct([("removed", pa.int64()), ("spans", pa.int64()), ("sha", pa.string())])

    @F.arrow_udf("removed bigint, spans bigint, sha string")
    def judge(raws: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for raw, listed in zip(raws, found):
            raw, runs = raw.as_py(), _merged(listed.as_py() or [])
            kept = _kept(raw, runs)
            out.append({"removed": len(raw) - len(kept), "spans": len(runs), "sha": hashlib.sha256(kept).hexdigest()})
        return pa.array(out, kind)

    texts = _possibly(documents, spans).select(F.col("id").alias("l_id"), F.col("t").alias("l_t"), "raw")
    joined = texts.join(spans.select(F.col("id").alias("r_id"), F.col("t").alias("r_t"), "spans"), _same("l", "r"), "left")
    cut = joined.select(F.col("l_id").alias("doc_id"), F.octet_length("raw").cast("bigint").alias("n_bytes"), judge("raw", "spans").alias("j"))
    cut = cut.select("doc_id", "n_bytes", F.col("j.removed").alias("n_removed"), F.col("j.spans").alias("n_spans"), F.col("j.sha").alias("kept_sha256"))
    whole = _possibly(documents, spans, wanted=False)
    zero = F.lit(0).cast("bigint")
    whole = whole.select(F.col("id").alias("doc_id"), F.octet_length("raw").cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("raw", 256).alias("kept_sha256"))
    return cut.unionByName(whole)


def remove(documents: DataFrame) -> DataFrame:
    """The documents without repeated bytes, with all their columns; a NULL text stays NULL."""
    spans = covered(documents).select(F.col("id").alias("r_id"), F.col("t").alias("r_t"), "spans")

    @F.arrow_udf("string")
    def cut(raws: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([None if r.as_py() is None else _kept(r.as_py(), _merged(f.as_py() or [])).decode("utf-8", "ignore") for r, f in zip(raws, found)], pa.string())

    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    rows = rows.withColumn("l_id", F.col("row.doc_id").cast("bigint")).withColumn("l_t", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    joined = rows.join(spans, _same("l", "r"), "left")
    return joined.select(F.col("row").withField("text", cut(F.col("row.text").cast("binary"), F.col("spans"))).alias("row")).select("row.*")
