"""Document fingerprints: SimHash, and permuted block tables that find near fingerprints.

The terms of a text are its pairs of neighbouring words (A-Z lower-cased, split at white space) and its
single words; a term votes once per occurrence, a pair with weight 2. Votes are counted in packed lanes,
16 sums for 64 bits, over chunks that cannot overflow a lane. DataFrame functions only.

A NULL or empty text has no terms and the fingerprint of 64 zero bits; equal texts have equal
fingerprints. Rows are told apart by ``doc_id`` and text, so repeated ids, NULL ids and repeated rows
each get a result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattgrid.session import staged

BITS = 64
LANES = 0x0001000100010001
# Words per chunk: each gives at most 3 votes, and the highest lane may reach 32,767 without overflow.
CHUNK_WORDS = 8_192
RADIUS = 3
BLOCKS = 6
NEIGHBOUR_BUCKETS = 256

_WORDS = r"[ \t\n\x0B\f\r]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _WORDS), lambda w: w != "")


def _term_votes(texts: DataFrame) -> DataFrame:
    """Lanes ``w0 .. w15`` of summed bits and the number of votes, per key, row and chunk of words."""
    listed = texts.select("key", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1)), F.lit(CHUNK_WORDS))
    # A chunk takes one more word, so that the pair over its edge is not lost.
    parts = F.transform(starts, lambda s: F.slice(F.col("w"), s, CHUNK_WORDS + 1))
    chunks = listed.select("key", "row", F.posexplode(parts).alias("chunk", "w"))
    hashes = F.zip_with(
        "w", F.slice("w", 2, CHUNK_WORDS + 1),
        lambda a, b: F.struct(F.xxhash64(a).alias("one"), F.when(b.isNotNull(), F.xxhash64(a, b)).alias("two")),
    )
    terms = chunks.select("key", "row", "chunk", F.explode(F.slice(hashes, 1, CHUNK_WORDS)).alias("h")).select("key", "row", "chunk", "h.one", "h.two")
    pair = F.col("two").isNotNull().cast("bigint")

    def lane(j: int) -> Column:
        one, two = (F.shiftrightunsigned(c, j).bitwiseAND(F.lit(LANES)) for c in ("one", "two"))
        return one + F.coalesce(two * 2, F.lit(0))

    # The row number only keeps rows of one key apart, so that no lane gets more than one chunk.
    return terms.groupBy("key", "row", "chunk").agg(*[F.sum(lane(j)).alias(f"w{j}") for j in range(16)], F.sum(pair * 2 + 1).alias("votes"))


def fingerprints(texts: DataFrame) -> DataFrame:
    """``key, fingerprint`` (64 bits as a long) for each ``key`` of ``key, text``. Rows of one key count
    together, and repeating them changes nothing. Keys without any term are left out."""
    lanes = _term_votes(texts)
    summed = lanes.groupBy("key").agg(
        F.sum("votes").alias("votes"),
        *[F.sum(F.shiftrightunsigned(f"w{j % 16}", 16 * (j // 16)).bitwiseAND(F.lit(0xFFFF))).alias(f"b{j}") for j in range(BITS)],
    )
    value = F.lit(0).cast("bigint")
    for j in range(BITS):
        bit = F.lit(1 << j if j < 63 else -(1 << 63)).cast("bigint")
        value = value.bitwiseOR(F.when(F.col(f"b{j}") * 2 > F.col("votes"), bit).otherwise(F.lit(0).cast("bigint")))
    return summed.select("key", value.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hexadecimal(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _masks(radius: int) -> list[int]:
    """For each permuted table the bits of its key: one choice of ``BLOCKS - radius`` blocks."""
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, BLOCKS - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def near_pairs(left: DataFrame, right: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``left, right, distance`` for all pairs of different fingerprints within the radius. Both inputs have
    one column ``fingerprint`` of distinct values. Every choice of ``BLOCKS - radius`` blocks is one
    permuted table; two fingerprints within the radius agree on at least one choice, and the first
    table on which they agree reports them."""
    masks = _masks(radius)

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(n).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m).cast("bigint")).alias("block")) for n, m in enumerate(masks)])
        found = df.select(F.col("fingerprint").alias(name), F.explode(keys).alias("k"))
        return found.select(name, F.col("k.table").alias(f"{name}_table"), F.col("k.block").alias(f"{name}_block"))

    differing = F.col("left").bitwiseXOR(F.col("right"))
    first = F.coalesce(*[F.when(differing.bitwiseAND(F.lit(m).cast("bigint")) == 0, F.lit(n)) for n, m in enumerate(masks)])
    distance = F.bit_count(differing)
    meet = (F.col("left_table") == F.col("right_table")) & (F.col("left_block") == F.col("right_block"))
    pairs = tables(left, "left").join(tables(right, "right"), meet & (distance <= radius) & (distance > 0) & (first == F.col("left_table")))
    return pairs.select("left", "right", distance.alias("distance"))


def following(ids: DataFrame) -> DataFrame:
    """``id, next_id`` over distinct ids in ascending order; the first follows the last. Ids are cut into
    ranges of equal width, so no task sorts them all; ranges meet through their first ids."""
    ids = ids.select("id").where(F.col("id").isNotNull()).distinct()
    span = ids.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
    # One row of three numbers; the number of ranges follows the number of ids.
    row = span.first()
    if not row["n"]:
        return ids.select("id", F.col("id").alias("next_id"))
    ranges = max(NEIGHBOUR_BUCKETS, row["n"] // 100_000)
    width = -(-(row["high"] - row["low"] + 1) // ranges)
    # Doubles keep the order of ids, whatever their range.
    placed = ids.withColumn("range", F.floor((F.col("id").cast("double") - float(row["low"])) / float(width)))
    inside = placed.withColumn("next_id", F.lead("id").over(Window.partitionBy("range").orderBy("id")))
    firsts = placed.groupBy("range").agg(F.min("id").alias("first"))
    firsts = firsts.select("range", F.lead("first", 1, row["low"]).over(Window.orderBy("range")).alias("next_first"))
    return inside.join(firsts, "range").select("id", F.coalesce("next_id", "next_first").alias("next_id"))


NO_ID = -(1 << 63)  # stands for a NULL id, which has no next document


def edited(documents: DataFrame, replaced: int = 4) -> DataFrame:
    """``id, text, next_id, edited``: each row with its last ``floor(n / replaced)`` code points replaced
    by the first as many of the next document (ascending id; of a repeated id, the smallest such head).
    """
    rows = documents.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    size = F.floor(F.length("text") / replaced).cast("int")
    needed = rows.where(F.col("id") != NO_ID).groupBy("id").agg(F.max(size).alias("needed"))
    # These sides grow with the documents: small as they look when compressed, they are not broadcast.
    asked = following(needed).join(needed.hint("merge"), "id").select("next_id", F.col("id").alias("asker"), "needed")
    # The donor's head goes to the asker: one per id, at most a quarter of the asker's text long.
    heads = rows.join(asked.hint("merge"), F.col("id") == F.col("next_id")).groupBy("asker", "next_id").agg(F.min(F.expr("substring(text, 1, needed)")).alias("head"))
    joined = rows.join(heads.hint("merge"), F.col("id") == F.col("asker"), "left")
    kept = F.substr(F.col("text"), F.lit(1), F.length("text") - size)
    added = F.substr(F.coalesce("head", F.lit("")), F.lit(1), size)
    return joined.select("id", "text", "next_id", F.concat(kept, added).alias("edited"))


def compare(documents: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """For each document row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (hex),
    ``near_edited, near_next`` (shares of equal bits; without a next document its text is empty), and
    for the search queries, the rows whose id is a multiple of ``every``, ``n_near``: how many other
    rows lie within ``radius`` bits."""
    texts = edited(documents)
    key = F.struct("id", F.xxhash64("text").alias("t"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"))))
    votes = fingerprints(texts.select(key.alias("key"), both.alias("x")).select(F.struct("key", "x.side").alias("key"), "x.text"))
    sides = votes.groupBy("key.key").agg(
        F.coalesce(F.max(F.when(F.col("key.side") == 0, F.col("fingerprint"))), F.lit(0)).alias("f"),
        F.coalesce(F.max(F.when(F.col("key.side") == 1, F.col("fingerprint"))), F.lit(0)).alias("g"),
    )
    facts = texts.select(key.alias("key"), "id", "next_id", F.length("text").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    zero = F.lit(0).cast("bigint")
    known = staged(facts.join(sides, "key", "left").select(
        "id", "next_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_sha256",
        F.coalesce("f", zero).alias("f"), F.coalesce("g", zero).alias("g"),
    ))
    nexts = known.groupBy(F.col("id").alias("n_id")).agg(F.min("f").alias("n"))
    held = known.groupBy("f").agg(F.count("*").alias("copies"))
    queries = known.where((F.col("id") != NO_ID) & (F.col("id") % every == 0)).select(F.col("f").alias("fingerprint")).distinct()
    pairs = near_pairs(queries, held.select(F.col("f").alias("fingerprint")), radius)
    others = pairs.join(held, F.col("right") == F.col("f")).groupBy("left").agg(F.sum("copies").alias("others"))
    same = held.select(F.col("f").alias("same"), F.col("copies"))
    found = queries.join(same, F.col("fingerprint") == F.col("same")).join(others, F.col("fingerprint") == F.col("left"), "left")
    counted = found.select(F.col("fingerprint").alias("q"), (F.col("copies") - 1 + F.coalesce("others", zero)).alias("near"))
    rows = known.join(nexts.hint("merge"), F.col("next_id") == F.col("n_id"), "left").join(counted, F.col("f") == F.col("q"), "left")
    return rows.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_chars", "edited_sha256",
        hexadecimal(F.col("f")).alias("fingerprint"), hexadecimal(F.col("g")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g")).alias("near_edited"), likeness(F.col("f"), F.coalesce("n", zero)).alias("near_next"),
        F.when(F.col("id") % every == 0, F.col("near")).alias("n_near"),
    )
