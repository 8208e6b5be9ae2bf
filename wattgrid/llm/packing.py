"""Best-fit packing with certified bounds: token pieces into sequences of fixed capacity.

Documents are tokenised once; longer ones are cut into full pieces. Pieces are dealt over partitions of
bounded size by a hash, and each partition runs best-fit decreasing. A lower bound from dual-feasible
functions certifies the partition's bin count; partitions above their (unrounded) bound release the
documents of unfilled bins, which are dealt anew together and packed again, until nothing is
released or a round saves nothing.

A NULL or empty text is the end token alone. Repeated document rows are packed as documents of their
own. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattgrid.session import staged

CAPACITY = 2048
END_ID = 0
PIECES_PER_PARTITION = 20_000
ROUNDS = 6
CACHED_WORDS = 800_000
JOINED = 1024
TEXTS_AT_ONCE = 500

# Splitting a word here never changes its ids: the tokenizer separates these from letters as well. The
# apostrophe (contractions) and the characters of special tokens are left out.
_EDGES = "".join(c for c in string.punctuation if c not in "'<|>").encode()


# The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 characters stand for
# themselves, the others for the characters from 256 on, in order.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_END, _MARK = "</w>", b"\x01"  # a word's end in the vocabulary; a byte that no word of letters holds
_BYTE_LETTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _OWN)}


def _is_letters(word: bytes) -> bool:
    """Letters of ASCII, or of any script once decoded."""
    return word.isalpha() or (not word.isascii() and word.decode("utf-8", "surrogatepass").isalpha())


def _merges(tokenizer):
    """The tokenizer's merges alone, for units that end in the mark. Ids of such vocabularies are their merges'
    ranks: single bytes first, then bytes that end a word, then the merges in their order."""
    import tiktoken

    special, byte, ranks = tokenizer.get_added_tokens_decoder(), {c: b for b, c in _letters().items()}, {}
    for piece, i in tokenizer.get_vocab().items():
        if i not in special:
            body = piece.removesuffix(_END)
            ranks[bytes(byte[c] for c in body) + (_MARK if body != piece else b"")] = i
    return tiktoken.Encoding("words", pat_str=r"[^\x01]*\x01", mergeable_ranks=ranks, special_tokens={})


def _letters() -> dict[int, str]:
    """The vocabulary's letter of each byte."""
    return {b: chr(b) for b in _OWN} | _BYTE_LETTERS


class WordIds(dict):
    """Ids of words between ASCII white space, as packed unsigned 32-bit numbers; filled on demand.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids in
    order. The size is bounded: a full table starts anew."""

    def __init__(self, tokenizer, limit: int = CACHED_WORDS):
        super().__init__()
        self.tokenizer, self.limit, self.parts = tokenizer, limit, {}
        self.ending = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ending[[i for piece, i in tokenizer.get_vocab().items() if piece.endswith(_END)]] = True
        self.merges = _merges(tokenizer)

    def _part(self, part: bytes) -> bytes:
        """Ids of an edge or of a word that is no single unit."""
        if not part:
            return b""
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) >= self.limit:
                self.parts.clear()
            ids = self.tokenizer.encode(part.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
            found = self.parts[part] = np.array(ids, "<u4").tobytes()
        return found

    def _unit(self, word: bytes) -> bytes:
        """Ids of one unit of letters: the merges alone decide, over the byte alphabet of the vocabulary."""
        text = word.decode("utf-8", "surrogatepass")
        plain = text.lower() if word.isascii() else self.tokenizer.normalizer.normalize_str(text)
        if not plain.isalpha():
            return self._part(word)
        spelt = plain if plain.isascii() else plain.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return np.array([t.id for t in self.tokenizer.model.tokenize(spelt)], "<u4").tobytes()

    def learn(self, words: Iterable[bytes]) -> None:
        """Tokenise many new words of letters at once: by the vocabulary's merges, each as one unit."""
        fresh = {w.strip(_EDGES) for w in words if w not in self}
        plain = [c for c in fresh if c not in self and _is_letters(c)]
        if len(self) + len(fresh) > self.limit:
            self.clear()
        for at in range(0, len(plain), JOINED):
            lot = plain[at : at + JOINED]
            text = (_MARK.join(lot) + _MARK).decode("utf-8", "surrogatepass")
            text = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
            ids = np.array(self.merges.encode_ordinary(text), "<u4")
            ends = (4 * (np.flatnonzero(self.ending[ids]) + 1)).tolist()
            # A letter may become several signs in lower case; such a lot is looked up word by word.
            if len(ends) == len(lot) and text.replace(_MARK.decode(), "").isalpha():
                raw = ids.tobytes()
                self.update((w, raw[a:b]) for w, a, b in zip(lot, [0, *ends], ends))

    def __missing__(self, word: bytes) -> bytes:
        tail = word.lstrip(_EDGES)
        core = tail.rstrip(_EDGES)
        if len(core) == len(word):
            ids = self._unit(word) if _is_letters(word) else self._part(word)
        elif not core or _is_letters(core):
            ids = self._part(word[: len(word) - len(tail)]) + (self[core] if core else b"") + self._part(tail[len(core):])
        else:
            ids = self._part(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids
        return ids


PIECE_DDL = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_PIECES = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))


def cut(ids: bytes, capacity: int) -> list[dict]:
    """Pieces of at most ``capacity`` ids with the checksum of their packed ids."""
    step = 4 * capacity
    return [
        {"piece": k, "start": k * capacity, "length": len(ids[at:at + step]) // 4, "ids_crc32": zlib.crc32(ids[at:at + step])}
        for k, at in enumerate(range(0, len(ids), step))
    ]


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document row."""
    end = np.array([end_id], "<u4").tobytes()

    @F.arrow_udf(PIECE_DDL)
    def tokenised(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        words = WordIds(Tokenizer.from_file(tokenizer_path))
        lookup = words.__getitem__
        for texts in batches:
            raw, made = texts.cast(pa.binary()), []
            for lot in range(0, len(raw), TEXTS_AT_ONCE):
                split = [(t or b"").split() for t in raw[lot : lot + TEXTS_AT_ONCE].to_pylist()]
                words.learn(set(chain.from_iterable(split)))
                made += [cut(b"".join(map(lookup, s)) + end, capacity) for s in split]
            yield pa.array(made, _PIECES)

    rows = documents.select("doc_id", F.explode(tokenised(F.col("text"))).alias("p"))
    return rows.select("doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32")


def fractional_bound(lengths: np.ndarray, capacity: int) -> float:
    """The largest bound of two families of dual-feasible functions, not rounded up."""
    if not len(lengths):
        return 0.0
    count = np.bincount(lengths, minlength=capacity + 1).astype(float)
    size = np.arange(capacity + 1)
    number, volume = np.cumsum(count), np.cumsum(count * size)
    # Sizes above capacity - e count whole, sizes below e not at all, the rest by their size.
    e = np.arange(1, capacity // 2 + 1)
    best = volume[-1] / capacity
    best = max(best, float((number[-1] - number[capacity - e] + (volume[capacity - e] - volume[e - 1]) / capacity).max()))
    # Rounding functions: (k + 1) x / capacity rounded down to whole k-ths, unless it is whole already.
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size / capacity, np.floor(scaled / capacity) / k)
        best = max(best, float((count * value).sum()))
    return best


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length; the lengths must be in decreasing order."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free capacity
    free_sizes, used, bins, offsets = 0, 0, [], []  # free_sizes: bit c is set if a bin has c free
    for n in lengths:
        fitting = free_sizes >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            at = open_bins[free].pop()
            if not open_bins[free]:
                free_sizes &= ~(1 << free)
        else:
            free, at, used = capacity, used, used + 1
        bins.append(at)
        offsets.append(capacity - free)
        if free > n:
            open_bins[free - n].append(at)
            free_sizes |= 1 << (free - n)
    return bins, offsets


_OUT = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, released boolean"
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _released(fill: np.ndarray, gap: float, capacity: int) -> np.ndarray:
    """The bins whose documents a partition gives up: none at its bound, else its unfilled bins, and
    where these are most of its bins a few of the emptiest for each bin above the bound."""
    unfilled = int((fill < capacity).sum())
    out = np.zeros(len(fill), bool)
    if gap > 1e-9:
        number = unfilled if 2 * unfilled <= len(fill) else min(unfilled, 4 * (int(np.ceil(gap)) + 1))
        out[np.argsort(fill, kind="stable")[:number]] = True
    return out


def _packer(capacity: int, turn: int):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table["length"].to_numpy()
        bins, offsets = (np.array(x, np.int64) for x in best_fit_decreasing(lengths.tolist(), capacity))
        fill = np.bincount(bins, lengths)
        released = _released(fill, len(fill) - fractional_bound(lengths, capacity), capacity)[bins]
        ids = (turn << 56) + (key[0].as_py() << 28) + bins
        return pa.table([*(table[c] for c in _NAMES[:5]), pa.array(ids), pa.array(offsets), pa.array(released)], names=_NAMES)

    return pack


def pack(items: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``items`` must be a stored table."""
    done, pool = [], items
    for turn in range(rounds):
        n = pool.count()
        if not n:
            break
        parts = -(-n // per_partition)
        dealt = pool.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts)))
        packed = staged(dealt.groupBy("part").applyInArrow(_packer(capacity, turn), _OUT))
        if turn and sequences(packed) >= sequences(pool):
            done.append(pool)  # dealing anew saved nothing
            break
        if parts == 1 or turn == rounds - 1:
            done.append(packed.drop("released"))
            break
        done.append(packed.where(~F.col("released")).drop("released"))
        pool = packed.where("released").drop("released")
    if not done:
        return items.withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def sequences(packed: DataFrame) -> int:
    """Number of sequences in use."""
    return packed.agg(F.count_distinct("sequence_id")).first()[0]


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(staged(pieces(documents, tokenizer_path, capacity)), capacity)
