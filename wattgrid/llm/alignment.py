"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often corpus-wide.

Both token sequences cut the same bytes. Every pair of neighbouring cuts, of either tokenizer, encloses bytes
of exactly one token each: one link. Cuts that both share bound the groups. A space that follows a visible
character is a shared cut, whatever stands around it, so texts are split there, and each different unit of
a slice of texts is tokenised and aligned once.

Counts of id pairs. A first pass over the texts gives the different pairs with their number per task. The
different pairs are indexed by a minimal perfect hash, built in parts of bounded size; tasks add their numbers
into dense vectors by that index, and the vectors are summed slice by slice in two levels. A second pass aligns the
documents again and looks the counts up; a pair that is not found under its key stops the job. Function,
keys and counts go to the tasks in segments of at most ``SEGMENT_KEYS`` pairs, and a worker holds one segment
at a time where there are several. All segments together grow with the number of different pairs, at
most the product of the two vocabularies' sizes, not with the number of documents.

A NULL or empty text has no tokens, nor has a text that one of the tokenizers does not give back byte by byte:
its numbers are 0 and its groups empty. Very long texts are ordinary rows (a unit without any space is tokenised in
one piece). Repeated rows and ids count each time; rows with a NULL id are ordinary rows. Of an id's links, all
that tie with its highest count are best ones. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrid.llm import perfect_hash
from wattgrid.session import staged

SEGMENT_KEYS = 1 << 21
PART_KEYS = 1 << 15
SLICE = 1 << 14
FAN = 64
SLICE_BYTES = 5 << 20
JOINED = 128
LOTS_AT_ONCE = 64

# A space that follows white space (or begins the text) may belong to what stands before it.
_IRREGULAR = r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\p{Z}] |^ "
_UNIT = re.compile(r"(?<=\S)(?= )")

# The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 characters stand for
# themselves, the others for the characters from 256 on, in order.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER_BYTE = {chr(b): b for b in _OWN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _OWN)}

PATHS = tuple[str, str]


class Tokens:
    """Both tokenizers, with the bytes of their tokens. Made by each task: a copied tokenizer forgets that
    special tokens are plain text."""

    def __init__(self, paths: PATHS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.vocab_size()
        of_a = {i: bytes(_LETTER_BYTE.get(c, 0) for c in piece) for piece, i in self.a.get_vocab().items()}
        self.bytes_a = [of_a.get(i, b"") for i in range(self.n_a)]
        self.bytes_b = [self._piece(i) for i in range(self.n_b)]
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b)]
        self.space = self.b.piece_to_id("▁")
        # An id as it stands in a group's text, with the sign that follows inside a group and at its end.
        told = [f"{i}{sign}" for n, signs in ((self.n_a, ",|"), (self.n_b, ",;")) for i in range(n) for sign in signs]
        self.told = pa.array(told, pa.string())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers for each text with a leading space."""
        a = [e.ids for e in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]
        # The sentence-piece model puts the space itself, but gives an empty text no token.
        return a, [ids if t else [self.space] for t, ids in zip(texts, self.b.encode(texts, num_threads=1))]

    def given_back(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether both tokenizers' bytes are the text's bytes."""
        raw = [f" {t}".encode() for t in texts]
        joined = [[b"".join([table[i] for i in ids]) for ids in lists] for table, lists in ((self.bytes_a, a), (self.bytes_b, b))]
        return np.array([r == x == y for r, x, y in zip(raw, *joined)], bool)


def _flat(lists: Iterable[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


class Aligned:
    """The alignment of different units, given without their leading spaces. ``place`` is the number that
    each unit has here; by it stand the numbers of tokens, groups and links of the units, and behind one
    another the pair keys of their links. Units that a tokenizer does not give back are the last ones, from
    ``n_good`` on, and have no tokens."""

    def __init__(self, tokens: Tokens, words: pa.Array):
        units = words.to_pylist()
        # Units that end visibly can be read as one text: the space of the next one is a shared cut.
        joined = [i for i, u in enumerate(units) if u and not u[-1].isspace()]
        lots = [joined[at : at + JOINED] for at in range(0, len(joined), JOINED)]
        lots += [[i] for i, u in enumerate(units) if not u or u[-1].isspace()]
        order, bad, a, b = [], [], [], []
        for at in range(0, len(lots), LOTS_AT_ONCE):  # the tokenizers' results are large objects
            self._encode(tokens, units, lots[at : at + LOTS_AT_ONCE], order, bad, a, b)
        self.n_good = len(order)
        self.tokens, self.a, self.b = tokens, *(np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
        order = np.array(order + bad, np.int64)
        self.place = np.empty(len(units), np.int64)
        self.place[order] = np.arange(len(units))
        # All units stand behind one another; every unit's end is a cut of both tokenizers.
        size = pc.binary_length(words).to_numpy()[order].astype(np.int64) + 1
        size[self.n_good :] = 0
        end_a, end_b = np.cumsum(tokens.sizes[0][self.a]), np.cumsum(tokens.sizes[1][self.b])
        cut_a, cut_b = (np.zeros(int(size.sum()) + 1, bool) for _ in range(2))
        cut_a[end_a] = cut_b[end_b] = True
        cuts = np.flatnonzero(cut_a | cut_b)
        cut_a, cut_b = cut_a[cuts], cut_b[cuts]
        shared = cut_a & cut_b
        # What ends at a cut belongs to the tokens and the group that begin after the cuts before it.
        a_before, b_before, g_before = (np.cumsum(c) - c for c in (cut_a, cut_b, shared))
        self.pairs = self.a[a_before] * tokens.n_b + self.b[b_before]
        self.group_a, self.group_b = g_before[cut_a], g_before[cut_b]
        units_end = np.searchsorted(cuts, np.cumsum(size), side="right")
        # The numbers of cuts of either kind up to each unit's end.
        upto = lambda c: np.concatenate([np.zeros(1, np.int64), np.cumsum(c)])[units_end]
        self.n_links = np.diff(units_end, prepend=0)
        self.n_a, self.n_b, self.n_groups = (np.diff(upto(c), prepend=0) for c in (cut_a, cut_b, shared))

    def _encode(self, tokens: Tokens, units: list[str], lots: list[list[int]], order: list, bad: list, a: list, b: list) -> None:
        """Append the lots' units and ids; a lot that is not given back is tried unit by unit."""
        texts = [" ".join([units[i] for i in lot]) for lot in lots]
        ids_a, ids_b = tokens.encode(texts)
        good = tokens.given_back(texts, ids_a, ids_b)
        order += chain.from_iterable(compress(lots, good))
        a.append(_flat(compress(ids_a, good)))
        b.append(_flat(compress(ids_b, good)))
        left = [lot for lot, ok in zip(lots, good) if not ok]
        bad += [lot[0] for lot in left if len(lot) == 1]
        single = [[i] for lot in left if len(lot) > 1 for i in lot]
        for at in range(0, len(single), JOINED):
            self._encode(tokens, units, single[at : at + JOINED], order, bad, a, b)

    def told(self) -> pa.Array:
        """The groups of each unit as text, each with a semicolon behind it."""
        groups = int(self.group_a[-1]) + 1 if len(self.a) else 0
        first_a, first_b = (np.searchsorted(g, np.arange(groups + 1)) for g in (self.group_a, self.group_b))
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        # Before a token of A stand the earlier tokens of A and the earlier groups' tokens of B.
        i, j = np.arange(len(self.a)), np.arange(len(self.b))
        code[i + first_b[self.group_a]] = 2 * self.a + (i + 1 == first_a[self.group_a + 1])
        code[j + first_a[self.group_b + 1]] = 2 * (self.tokens.n_a + self.b) + (j + 1 == first_b[self.group_b + 1])
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.n_a + self.n_b)]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.tokens.told.take(pa.array(code))), "")


class Block:
    """Some texts of a batch: ``rows`` are their positions, ``unit`` the number of each text's units in
    order, ``first`` where a text's units begin, ``found`` the alignment of the different units. Texts that are
    not given back are left out."""

    def __init__(self, tokens: Tokens, rows: np.ndarray, words: pa.Array, counts: np.ndarray):
        coded = words.dictionary_encode()
        self.found = Aligned(tokens, coded.dictionary)
        self.unit = self.found.place[coded.indices.to_numpy()]
        if self.found.n_good < len(self.found.place):
            bad = np.maximum.reduceat(self.unit, np.cumsum(counts) - counts) >= self.found.n_good
            self.unit = self.unit[np.repeat(~bad, counts)]
            rows, counts = rows[~bad], counts[~bad]
        self.rows, self.first = rows, np.cumsum(counts) - counts
        self.held = np.bincount(self.unit, minlength=len(self.found.place))

    def sums(self, per_unit: np.ndarray) -> np.ndarray:
        """For each text the sum over its units."""
        return np.add.reduceat(per_unit[self.unit], self.first) if len(self.first) else np.zeros(0, np.int64)

    def unit_sums(self, per_link: np.ndarray) -> np.ndarray:
        """For each different unit the sum over its links."""
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_link)])
        ends = np.cumsum(self.found.n_links)
        return total[ends] - total[ends - self.found.n_links]

    def told(self) -> pa.Array:
        """The groups of each text."""
        offsets = np.append(self.first, len(self.unit)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.found.told().take(pa.array(self.unit))), "")
        return pc.utf8_rtrim(texts, ";")


def _blocks(tokens: Tokens, texts: pa.Array) -> Iterator[Block]:
    """The texts that have any bytes, split into units; regular white space is split by Arrow."""
    irregular = pc.match_substring_regex(texts, _IRREGULAR)
    rows = np.arange(len(texts))
    plain = pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(irregular)).fill_null(False).to_numpy(zero_copy_only=False)
    if plain.any():
        words = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        yield Block(tokens, rows[plain], words.flatten(), pc.list_value_length(words).to_numpy().astype(np.int64))
    odd = irregular.fill_null(False).to_numpy(zero_copy_only=False)
    if odd.any():
        split = [[u[1:] for u in _UNIT.split(f" {t}")] for t in texts.filter(pa.array(odd)).to_pylist()]
        yield Block(tokens, rows[odd], pa.array([u for s in split for u in s], pa.string()), np.array([len(s) for s in split], np.int64))


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``SLICE_BYTES`` of text (a longer text is a piece of its own)."""
    size = np.cumsum(pc.binary_length(batch["text"]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(size):
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and their summed counts."""
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    return every, total


def pair_counts(documents: DataFrame, paths: PATHS) -> DataFrame:
    """``pair, n``: the different pair keys of each task's texts with their number of links."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, keys, counts, size = Tokens(paths), [], [], 0
        for batch in batches:
            for piece in _sliced(batch):
                for block in _blocks(tokens, piece["text"]):
                    key, n = _merged([block.found.pairs], [np.repeat(block.held, block.found.n_links)])
                    keys.append(key[n > 0])
                    counts.append(n[n > 0])
                    size += len(keys[-1])
                    if size > 1 << 21:
                        key, n = _merged(keys, counts)
                        keys, counts, size = [key], [n], 0
        if keys:
            key, n = _merged(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])

    return documents.select("text").mapInArrow(count, "pair bigint, n bigint")


def _segment_of(pair: str, segments: int):
    return F.pmod(F.xxhash64(F.lit(7), F.col(pair)), F.lit(segments)).cast("int")


def _built(key: tuple, table: pa.Table) -> pa.Table:
    sizes, bits, order = perfect_hash.build(table["pair"].to_numpy())
    return pa.table({
        "part": pa.array([key[0].as_py()], pa.int32()), "n_bits": [len(bits)], "sizes": [sizes.tobytes()],
        "bits": [np.packbits(bits).tobytes()], "pairs": [order.astype(np.int64).tobytes()],
    })


def perfect_function(pairs: DataFrame, number: int) -> perfect_hash.PerfectHash:
    """The minimal perfect hash of ``number`` different pairs, built in parts by the tasks."""
    parts = -(-max(number, 1) // PART_KEYS)

    @F.arrow_udf("int")
    def part(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array(perfect_hash.class_of(keys.to_numpy(zero_copy_only=False), parts).astype(np.int32))

    shape = "part int, n_bits bigint, sizes binary, bits binary, pairs binary"
    rows = sorted(pairs.select("pair", part("pair").alias("part")).groupBy("part").applyInArrow(_built, shape).collect(), key=lambda r: r["part"])
    sizes = np.zeros((parts, perfect_hash.LEVELS + 1), np.int64)
    for r in rows:
        sizes[r["part"]] = np.frombuffer(r["sizes"], np.int64)
    bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n_bits"]).astype(bool) for r in rows]
    keys = [np.frombuffer(r["pairs"], np.int64) for r in rows]
    words = perfect_hash.packed(np.concatenate([np.zeros(0, bool), *bits]))
    return perfect_hash.PerfectHash(sizes, words, np.concatenate([np.zeros(0, np.int64), *keys]))


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(v.as_py(), np.int64) for v in table["counts"]], axis=0)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})


def dense_counts(counted: DataFrame, function: perfect_hash.PerfectHash) -> np.ndarray:
    """The corpus-wide count of each pair by index: dense vectors of the tasks, summed by slices in two levels."""
    shared = counted.sparkSession.sparkContext.broadcast((function.sizes, function.words, function.keys))
    size, slice_ = len(function.keys), SLICE

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, own = np.zeros(-(-size // slice_) * slice_, np.int64), perfect_hash.PerfectHash(*shared.value)
        for batch in batches:
            at = own.index(batch["pair"].to_numpy(zero_copy_only=False))
            total += np.bincount(at[at >= 0], batch["n"].to_numpy(zero_copy_only=False)[at >= 0], minlength=len(total)).astype(np.int64)
        for k, part in enumerate(total.reshape(-1, slice_)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()])], names=["slice", "counts"])

    vectors = counted.select("pair", "n").mapInArrow(vector, "slice int, counts binary")
    salted = vectors.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    once = salted.groupBy("slice", "salt").applyInArrow(lambda key, t: _summed(key, t), "slice int, counts binary")
    out = np.zeros(-(-size // slice_) * slice_, np.int64)
    for r in once.groupBy("slice").applyInArrow(_summed, "slice int, counts binary").toLocalIterator():
        out[r["slice"] * slice_ : (r["slice"] + 1) * slice_] = np.frombuffer(r["counts"], np.int64)
    shared.destroy()
    return out[:size]


def corpus_counts(spark: SparkSession, counted: DataFrame, n_b: int, segment_keys: int = SEGMENT_KEYS) -> tuple[list, np.ndarray]:
    """Broadcast counts of all pairs, in segments, and the highest count of each B id."""
    pairs = staged(counted.select("pair").distinct())
    segments = -(-max(pairs.count(), 1) // segment_keys)
    shared, best = [], np.zeros(n_b, np.int64)
    for k in range(segments):
        own = pairs.where(_segment_of("pair", segments) == k)
        function = perfect_function(own, own.count())
        counts = dense_counts(counted.where(_segment_of("pair", segments) == k), function)
        np.maximum.at(best, function.keys % n_b, counts)
        shared.append(spark.sparkContext.broadcast((function.sizes, function.words, function.keys, counts)))
    return shared, best


class Counts:
    """Corpus-wide counts of pairs, from the broadcast segments."""

    def __init__(self, shared: list):
        self.shared, self.loaded = shared, {}

    def _segment(self, k: int) -> tuple[perfect_hash.PerfectHash, np.ndarray]:
        if k not in self.loaded:
            self.loaded.clear()
            *function, counts = self.shared[k].value
            self.loaded[k] = perfect_hash.PerfectHash(*function), counts
            if len(self.shared) > 1:  # the next use reads it from the executor's disk again
                self.shared[k].__dict__.pop("_value", None)
        return self.loaded[k]

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """The counts of pairs, each of which occurs in the corpus."""
        found = np.zeros(len(pairs), np.int64)
        for k in range(len(self.shared)):
            function, counts = self._segment(k)
            at = function.index(pairs)
            found[at >= 0] = counts[at[at >= 0]]
        if not found.all():
            raise ValueError("a pair of the second pass was not counted by the first: the documents have changed between them")
        return found


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(documents: DataFrame, paths: PATHS, segment_keys: int = SEGMENT_KEYS) -> DataFrame:
    """For each document row ``doc_id``, the numbers of tokens, groups, links and best links, the sum of
    its links' corpus-wide counts, and ``groups``, the aligned ids as `a1,a2|b1;a3|b2,b3`. ``paths`` name
    a byte-level BPE tokenizer and a sentence-piece model that puts a space before the text."""
    counted = staged(pair_counts(documents, paths))
    n_b = Tokens(paths).n_b
    shared, best = corpus_counts(documents.sparkSession, counted, n_b, segment_keys)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, corpus = Tokens(paths), Counts(shared)
        for batch in batches:
            for piece in _sliced(batch):
                values = np.zeros((len(_NUMBERS), len(piece)), np.int64)
                rows, texts = [np.zeros(0, np.int64)], []
                for block in _blocks(tokens, piece["text"]):
                    found = block.found
                    used = np.repeat(block.held > 0, found.n_links)
                    counts = np.zeros(len(used), np.int64)
                    key, inverse = np.unique(found.pairs[used], return_inverse=True)
                    counts[used] = corpus.look_up(key)[inverse]
                    best_links = used & (counts == best[found.pairs % n_b])
                    per_unit = [found.n_a, found.n_b, found.n_groups, found.n_links, block.unit_sums(best_links), block.unit_sums(counts)]
                    for k, number in enumerate(per_unit):
                        values[k, block.rows] = block.sums(number)
                    texts.append(block.told())
                    rows.append(block.rows)
                at = np.concatenate(rows)
                place = np.full(len(piece), len(at), np.int64)  # rows without tokens take the empty text
                place[at] = np.arange(len(at))
                groups = pa.concat_arrays([*texts, pa.array([""], pa.string())]).take(pa.array(place))
                yield pa.RecordBatch.from_arrays([piece["doc_id"], *map(pa.array, values), groups], names=["doc_id", *_NUMBERS, "groups"])

    shape = "doc_id bigint, " + ", ".join(f"{n} bigint" for n in _NUMBERS) + ", groups string"
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(look_up, shape)
