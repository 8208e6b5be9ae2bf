"""Line dedup: lines that many documents share are kept in one document only.

Lines are exploded with their position and a 128-bit hash of their key (stripped, A-Z lower-cased);
different documents are counted per hash, and the positions of lines over the threshold are dropped
when the text is put together again. DataFrame functions only; a line that a third of all documents
hold is pre-aggregated before each shuffle, and the join on hashes may be split by the adaptive
planner.

A NULL or empty text is one empty line. Documents are told apart by ``doc_id`` (NULL is one id below
all others): rows that repeat a ``doc_id`` count as one document and each keeps or loses its own
lines. Extra columns are ignored by ``scan`` and kept by ``remove``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrid.session import staged

LEAST_CHARS = 40
LEAST_DOCS = 5

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII takes the quick function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keyed(documents: DataFrame) -> DataFrame:
    """``id, t, at, a, b`` for each line whose key is long enough: the document, a hash of its text
    (rows may share an id), the line's position and the 128-bit hash of its key."""
    texts = documents.select(F.col("doc_id").alias("id"), _text_hash(F.col("text")).alias("t"), _lines(F.col("text")).alias("lines"))
    lines = texts.select("id", "t", F.posexplode("lines").alias("at", "line"))
    keys = lines.select("id", "t", "at", F.btrim("line", F.lit(_BLANKS)).alias("key")).where(F.length("key") >= LEAST_CHARS)
    keys = keys.select("id", "t", "at", ascii_lower(F.col("key")).alias("key"))
    return keys.select("id", "t", "at", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _shared(keyed: DataFrame, least_docs: int) -> DataFrame:
    """``a, b, keeper``: hashes in enough different documents, and the one that keeps the line."""
    held = keyed.groupBy("a", "b", "id").agg(F.lit(1).alias("one"))
    counted = held.groupBy("a", "b").agg(F.count("one").alias("n"), F.max("id").alias("keeper"))
    return counted.where(F.col("n") >= least_docs).select("a", "b", "keeper")


def dropped_positions(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``id, t, drop``: for each document text the sorted positions of the lines to drop."""
    keyed = _keyed(documents)
    # Stored, so that the adaptive planner may split a line that very many documents hold.
    shared = staged(_shared(keyed, least_docs))
    lost = keyed.join(shared, ["a", "b"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("id", "t").agg(F.array_sort(F.collect_set("at")).alias("drop"))


def _gaps(lines: Column, drop: Column) -> Column:
    """The lines between the dropped positions, in order; linear in the number of lines."""
    before = lambda i: F.when(i > 0, F.get(drop, i - 1)).otherwise(F.lit(-1))
    after = lambda i: F.coalesce(F.get(drop, i), F.size(lines))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(drop)), lambda i: F.slice(lines, before(i) + 2, after(i) - before(i) - 1)))


def _judged(documents: DataFrame, least_docs: int) -> DataFrame:
    """``row, n_lines, kept``: the whole input row, its line count and the lines that stay."""
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.col("doc_id").alias("row_id"), _text_hash(F.col("text")).alias("row_t"),
    )
    drop = dropped_positions(documents, least_docs)
    joined = rows.join(drop, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_t") == F.col("t")), "left")
    lines = _lines(F.col("row.text"))
    kept = F.when(F.col("drop").isNull(), lines).otherwise(_gaps(lines, F.col("drop")))
    return joined.select("row", F.size(lines).alias("n_lines"), kept.alias("kept"))


def scan(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` (what is left) for each document row."""
    judged = _judged(documents, least_docs)
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_lines").cast("bigint").alias("n_lines"),
        (F.col("n_lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


def remove(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents without their dropped lines, with all their columns; a NULL text stays NULL."""
    judged = _judged(documents, least_docs)
    text = F.when(F.col("row.text").isNotNull(), F.array_join("kept", "\n"))
    return judged.select(F.col("row").withField("text", text).alias("row")).select("row.*")
