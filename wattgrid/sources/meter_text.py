"""Delimited meter files and the integrity of their content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wattgrid.operators.quality import METER_COLUMNS

BAD_RECORD = "_bad_record"
EXTRA = "_extra"
ROW_RANGE = 1 << 33
PATH_RANGE = 10**12
WHOLE_FILE = 64 << 20
CHUNK_BYTES = 4 << 20
# The file's own markers and formats.
MISSING = "?"
STAMP_FORMAT = "d/M/yyyy H:mm:ss"


def meter_schema(measurements: Sequence[str] = METER_COLUMNS) -> StructType:
    """Every field as text, and one more that only an overlong line fills."""
    return StructType([StructField(c, StringType()) for c in ("Date", "Time", *measurements, EXTRA)])


def compose_timestamp(date: str | Column = "Date", time: str | Column = "Time") -> Column:
    """``Date`` and ``Time`` text as TIMESTAMP_NTZ, NULL when they do not parse."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def with_timestamp(df: DataFrame, on_bad: str = "fail", ts: str = "ts") -> DataFrame:
    """Replace ``Date`` and ``Time`` by one timestamp.

    ``on_bad='fail'`` stops the query at the first date that does not parse, ``'quarantine'`` keeps
    the row with a NULL timestamp, ``'drop'`` leaves it out.
    """
    stamp = compose_timestamp()
    if on_bad == "fail":
        shown = F.format_string("unreadable timestamp: %s %s", F.col("Date"), F.col("Time"))
        stamp = F.coalesce(stamp, F.raise_error(shown).cast("timestamp_ntz"))
    elif on_bad not in ("quarantine", "drop"):
        raise ValueError(f"on_bad must be 'fail', 'quarantine' or 'drop', not {on_bad!r}")
    rest = [c for c in df.columns if c not in ("Date", "Time")]
    stamped = df.select(stamp.alias(ts), *rest)
    return stamped.where(F.col(ts).isNotNull()) if on_bad == "drop" else stamped


def read_meter_text(
    spark: SparkSession,
    path: str | list[str],
    measurements: Sequence[str] = METER_COLUMNS,
    on_bad: str = "fail",
    series: Column | str = "meter",
) -> DataFrame:
    """Meter records of one or many files: ``(series_id, ts, measurements..., ingest_ord)``.

    ``?`` and empty fields are missing values; a field that is no number, or a field too many, makes
    a line malformed, which ``on_bad`` treats like an unreadable date. ``series`` names the series: a constant, or an
    expression over ``_metadata`` such as the file name. ``ingest_ord`` is the file order that
    decides which of several records of a timestamp came first.
    """
    lines = (
        spark.read.schema(meter_schema(measurements))
        .option("sep", ";")
        .option("header", True)
        .option("nullValue", MISSING)
        .option("enforceSchema", True)
        .csv(path)
    )
    series_id = F.lit(series) if isinstance(series, str) else series
    # File (in the fixed order of a hash of its path), block offset, then row number. The row number
    # runs on over whatever blocks share a task, so it may only decide inside one block. A plain number
    # keeps the later pick a hash aggregate.
    path_hash = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(PATH_RANGE)).cast("decimal(12,0)")
    block = F.col("_metadata.file_block_start").cast("decimal(15,0)")
    row = (F.monotonically_increasing_id() % ROW_RANGE).cast("decimal(10,0)")
    place = (block * F.lit(Decimal(10**10)) + row).cast("decimal(25,0)")
    order = (path_hash * F.lit(Decimal(10**25))).cast("decimal(38,0)") + place
    order = order.cast("decimal(38,0)")
    ordered = lines.select(series_id.alias("series_id"), "*", order.alias("ingest_ord"))

    unreadable = F.col(EXTRA).isNotNull()
    for c in measurements:
        unreadable = unreadable | (F.col(c).isNotNull() & F.col(c).try_cast("float").isNull())
    line = F.concat_ws(";", *[F.coalesce(F.col(c), F.lit(MISSING)) for c in ("Date", "Time", *measurements)], EXTRA)
    noted = ordered.withColumn(BAD_RECORD, F.when(unreadable, line))
    if on_bad == "fail":
        broken = F.raise_error(F.concat(F.lit("malformed meter line: "), F.col(BAD_RECORD)))
        noted = noted.withColumn("Date", F.when(F.col(BAD_RECORD).isNotNull(), broken).otherwise(F.col("Date")))
    elif on_bad == "drop":
        noted = noted.where(F.col(BAD_RECORD).isNull())
    stamped = with_timestamp(noted, on_bad)
    extra = [BAD_RECORD] if on_bad == "quarantine" else []
    return stamped.select(
        "series_id", "ts", *[F.col(c).try_cast("float").alias(c) for c in measurements], "ingest_ord", *extra
    )


def file_digests(
    spark: SparkSession, path: str | list[str], whole_below: int = WHOLE_FILE, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """SHA-256 of every file: ``(path, length, digest)``.

    Files below ``whole_below`` bytes are records of Spark's binary source and stay in the JVM. Larger
    ones are listed by that source without their content and read ``chunk`` bytes at a time, so a task
    holds one chunk whatever the size of the file. For these the file system must be one that Arrow opens
    (local, HDFS, S3, GCS, Azure). A digest is sequential, so one file is one task's work.
    Empty files are not listed, as in all of Spark's file sources; a manifest reports them as missing.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") < whole_below)
    whole = small.select("path", "length", F.sha2("content", 256).alias("digest"))
    large = files.where(F.col("length") >= whole_below).select("path", "length")
    return whole.unionByName(large.mapInArrow(lambda it: _chunked_digests(it, chunk), "path string, length bigint, digest string"))


def _chunked_digests(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, length in zip(batch["path"].to_pylist(), batch["length"].to_pylist()):
            system, inside = fs.FileSystem.from_uri(path)
            digest, n = hashlib.sha256(), 0
            with system.open_input_stream(inside, buffer_size=0) as stream:
                while piece := stream.read(chunk):
                    digest.update(piece)
                    n += len(piece)
            if n != length:
                raise OSError(f"{path} had {length} bytes when listed, {n} when read")
            yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], names=["path", "length", "digest"])


def integrity_mismatches(digests: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of ``manifest(name, expected)`` that are missing or differ; ``name`` is the file name."""
    named = digests.withColumn("name", F.element_at(F.split("path", "/"), -1))
    joined = manifest.join(named, "name", "left")
    return joined.where(~F.col("digest").eqNullSafe(F.col("expected"))).select("name", "expected", "digest")


def verify_integrity(digests: DataFrame, manifest: DataFrame, shown: int = 10) -> None:
    """Raise when any file differs from the manifest."""
    bad = integrity_mismatches(digests, manifest).orderBy("name").take(shown)
    if bad:
        listed = "; ".join(f"{r['name']}: expected {r['expected']}, got {r['digest']}" for r in bad)
        raise ValueError(f"SHA-256 mismatch for {listed}")
