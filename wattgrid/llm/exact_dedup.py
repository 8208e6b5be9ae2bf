"""Exact dedup by distributed radix partitioning, most significant bytes first.

A text's bytes are cut into digits of growing width. All texts begin in one group; each level splits the
groups by the next digit, compared byte by byte, until a group holds one row or its texts have ended.
A row that is alone in its group leaves at once, so a text is read as far as it agrees with another
one, and only rows with company go on. Copies end together with their whole text compared; no digest takes
part in it.

Each level counts its rows per (group, digit) with partial aggregation, so a group of copies is one row per
task, keeps the shared digits with a new group number, and joins them to the rows. That join's tables
are plain, so the adaptive planner may split a group that holds a third of all rows. What a level leaves
is written in the shared folder; the number of levels grows with the logarithm of the longest common
prefix.

A NULL text counts as empty; very long texts take more levels. NULL ids are below all others. Rows that
repeat id and text are copies of one another: one of them stays. Extra columns are ignored by ``classes``
and kept by ``remove``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrid.session import staged

FIRST_BYTES = 128
GROWTH = 8


def _level(rows: DataFrame, start: int, width: int) -> DataFrame:
    """One level: the rows with ``n`` and ``keep`` of their new group, its number ``class`` (NULL for a row
    alone) and ``ended``."""
    digit = F.substring("raw", start + 1, width)
    cut = rows.withColumns({"digit": digit, "ended": F.length("raw") <= start + width})
    counted = cut.groupBy("class", "digit", "ended").agg(F.count("*").alias("n"), F.max("id").alias("keep")).where("n > 1")
    # Stored, so that group numbers are fixed and the join may be split.
    groups = staged(counted.select(
        F.col("class").alias("g"), F.col("digit").alias("d"), F.col("ended").alias("e"), "n", "keep", F.monotonically_increasing_id().alias("new"),
    ))
    # Groups grow with the documents, so they are never broadcast.
    joined = cut.join(groups.hint("merge"), (F.col("class") == F.col("g")) & (F.col("digit") == F.col("d")) & (F.col("ended") == F.col("e")), "left")
    return joined.select(
        "id", "carried", "raw", F.col("new").alias("class"), F.coalesce("n", F.lit(1)).alias("n"),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep"), (F.col("n").isNull() | F.col("ended")).alias("done"),
    )


def _split(rows: DataFrame, first_bytes: int, growth: int) -> list[DataFrame]:
    """The finished rows of each level: ``id, carried, class, n, keep, at``; ``class`` tells the groups of one
    level apart and ``at`` the rows."""
    done, start, width = [], 0, first_bytes
    rows = rows.withColumn("class", F.lit(0).cast("bigint"))
    while True:
        level = _level(rows, start, width)
        # The bytes of finished rows are not needed any more.
        level = staged(level.withColumn("raw", F.when(~F.col("done"), F.col("raw"))).withColumn("at", F.monotonically_increasing_id()))
        done.append(level.where("done").drop("raw", "done"))
        rows = level.where("not done").select("id", "carried", "raw", "class")
        if rows.isEmpty():
            return done
        start, width = start + width, (start + width) * (growth - 1)


def _kept(finished: DataFrame) -> DataFrame:
    """Finished rows with ``kept``: the row with the largest id, the first of rows that repeat it."""
    largest = finished.where((F.col("n") > 1) & F.col("id").eqNullSafe(F.col("keep")))
    first = largest.groupBy("class").agg(F.min("at").alias("first")).select(F.col("class").alias("c"), "first")
    joined = finished.join(first.hint("merge"), (F.col("class") == F.col("c")) & (F.col("at") == F.col("first")), "left")
    return joined.withColumn("kept", (F.col("n") == 1) | F.col("c").isNotNull())


def _marked(documents: DataFrame, carried: Column, first_bytes: int, growth: int) -> DataFrame:
    """``id, carried, n, keep, kept`` for each row."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(F.col("doc_id").alias("id"), carried.alias("carried"), raw.alias("raw"))
    out = None
    for level in _split(rows, first_bytes, growth):
        part = _kept(level).select("id", "carried", "n", "keep", "kept")
        out = part if out is None else out.unionByName(part)
    return out


def classes(documents: DataFrame, first_bytes: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row, dropped ones too."""
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    marked = _marked(documents, F.unhex(digest), first_bytes, growth)
    return marked.select(
        F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("n").cast("bigint").alias("group_size"), "kept",
        F.lower(F.hex("carried")).alias("text_sha256"),
    )


def remove(documents: DataFrame, first_bytes: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """The rows that stay, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    return _marked(documents, row, first_bytes, growth).where("kept").select("carried.*")
