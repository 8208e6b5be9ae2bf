"""Benchmark decontamination: find test items inside documents with one Aho-Corasick automaton.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. Every window of
``WINDOW`` consecutive item words becomes one pattern; the automaton reads each normalised text once,
and hits are mapped back to word numbers and to character offsets of the original text.

A NULL or wordless text has no words and is never contaminated; a NULL or wordless item has no
windows. Repeated document rows each get their own result row; repeated items (same ``item_id``) count
once. Extra columns of either table are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 13
# Items travel to the tasks as one broadcast block of at most so many bytes of text. A larger
# benchmark is cut into blocks, and each block is scanned in a pass of its own.
BLOCK_BYTES = 200_000

_SPACE_OUT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RESULT = pa.struct([
    ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])
RESULT_DDL = "n_words bigint, hits array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>, items array<string>"


def normalised_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_SPACE_OUT).split()


def item_windows(text: str | None, window: int) -> set[str]:
    """All windows of an item as strings with a blank before, between and after the words."""
    words = normalised_words(text)
    size = min(window, len(words))
    if not size:
        return set()
    return {f" {b' '.join(words[i:i + size]).decode()} " for i in range(len(words) - size + 1)}


def automaton(items: list[tuple[str, str | None]], window: int) -> ahocorasick.Automaton:
    """One automaton for all windows; each holds its word count and the items that have it."""
    owners: dict[str, set[str]] = {}
    for item_id, text in items:
        for pattern in item_windows(text, window):
            owners.setdefault(pattern, set()).add(item_id)
    found = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        found.add_word(pattern, (pattern.count(" ") - 1, tuple(sorted(ids))))
    found.make_automaton()
    return found


def scan_text(text: str | None, found: ahocorasick.Automaton) -> dict:
    """Word count, merged runs of hit words with their original offsets, and the items seen."""
    words = normalised_words(text)
    runs: list[list[int]] = []
    items: set[str] = set()
    if words and len(found):
        plain = f" {b' '.join(words).decode()} "
        matches = list(found.iter(plain))
        if matches:
            blanks = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), np.uint32) == 32)
            last = np.searchsorted(blanks, [end for end, _ in matches]) - 1
            ranges = sorted((int(at) - size + 1, int(at)) for at, (_, (size, _)) in zip(last, matches))
            for _, (_, ids) in matches:
                items.update(ids)
            for low, high in ranges:
                if runs and low <= runs[-1][1] + 1:
                    runs[-1][1] = max(runs[-1][1], high)
                else:
                    runs.append([low, high])
    hits = []
    if runs:
        spans = [m.span() for m in _WORD.finditer(text)]
        hits = [{"first": a, "last": b, "start": spans[a][0], "stop": spans[b][1]} for a, b in runs]
    return {"n_words": len(words), "hits": hits, "items": sorted(items)}


def _scanner(block: Broadcast, window: int):
    @F.arrow_udf(RESULT_DDL)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = automaton(block.value, window)
        for texts in batches:
            yield pa.array([scan_text(t.as_py(), found) for t in texts], type=RESULT)

    return scan


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of bounded size (one block unless the benchmark is very large)."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k) if count > 1 else items
        yield [(r.i, r.t) for r in part.collect()]


def scanners(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> list:
    """A scan function for each block of the benchmark."""
    context = benchmark.sparkSession.sparkContext
    return [_scanner(context.broadcast(block), window) for block in _blocks(benchmark, item_col, text_col)]


def merged(parts: list[Column]) -> Column:
    """Combine the scans of several blocks: all hit words, all items."""
    if len(parts) == 1:
        return parts[0]
    return F.struct(
        parts[0]["n_words"].alias("n_words"),
        F.flatten(F.array(*[p["hits"] for p in parts])).alias("hits"),
        F.array_distinct(F.flatten(F.array(*[p["items"] for p in parts]))).alias("items"),
    )


def hit_words(scan: Column) -> Column:
    """Number of different words inside hits; runs of several blocks may overlap."""
    step = F.aggregate(
        F.array_sort(scan["hits"]),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("upto")),
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(F.lit(0), h["last"] - F.greatest(h["first"] - 1, acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], h["last"]).alias("upto"),
        ),
    )
    return step["n"]


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """The contamination rule: at least one hit word, and hits make 5 % of the words or more."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document row: ``n_words, n_hit, hits`` (runs of hit words with original offsets),
    ``items`` (ids as strings) and ``contaminated``. No shuffle: documents stay where they are read."""
    parts = [f(F.col(text_col)) for f in scanners(benchmark, window)]
    found = documents.select(F.col(id_col).alias("doc_id"), merged(parts).alias("s"))
    counted = found.select("doc_id", F.col("s.n_words").alias("n_words"), hit_words(F.col("s")).alias("n_hit"), "s.hits", "s.items")
    return counted.withColumn("contaminated", contaminated(F.col("n_words"), F.col("n_hit")))


def remove(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    parts = [f(F.col(text_col)) for f in scanners(benchmark, window)]
    s = merged(parts)
    return documents.where(~contaminated(s["n_words"], hit_words(s)))
