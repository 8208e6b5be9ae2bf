"""Stored stages: hourly, feature and prediction tables, JSON summaries, fitted models."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wattgrid.functions.timeaxis import as_keys, quoted
from wattgrid.operators.forecast import align_predictions


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stored hourly, feature or prediction table."""
    return spark.read.parquet(path)


def _save(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def save_hourly(df: DataFrame, path: str, partition_by: Sequence[str] = ("series_id",)) -> str:
    """Write the hourly table. With very many series partition by a coarser column instead."""
    return _save(df, path, partition_by)


def save_features(df: DataFrame, path: str, partition_by: Sequence[str] = ("series_id",)) -> str:
    """Write the feature table."""
    return _save(df, path, partition_by)


def read_prediction_files(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of ``<model>.parquet`` files (or folders) as one table; the model is the stem."""
    files = spark.read.parquet(f"{folder}/*.parquet")
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet(?:/[^/]+)?$", 1)
    return files.select("*", stem.alias("model"))


def _stored(spark: SparkSession, path: str, model: str, horizon: str) -> bool:
    """Whether the table holds rows of this model and horizon."""
    try:
        found = read_predictions(spark, path)
    except AnalysisException:  # nothing stored yet
        return False
    return not found.where((F.col("model") == model) & (F.col("horizon") == horizon)).isEmpty()


def content_digest(df: DataFrame) -> str:
    """Digest of the rows as a set with repetitions, whatever their order and partitions.

    Two 64-bit hashes of each row are added up exactly, and their sums, the number of rows and the columns'
    names and types are digested. One pass; a NULL differs from every value, and the column it stands in counts.
    """
    names = sorted(df.columns)
    # A NULL leaves Spark's hash of a row as it was, so the pattern of NULLs is hashed with it.
    empty = [F.col(quoted(c)).isNull() for c in names]
    cells = [F.col(quoted(c)) for c in names]
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *cells, *empty).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)
    ]
    found = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    kinds = dict(df.dtypes)
    text = repr(([(c, kinds[c]) for c in names], found["n"], str(found["h1"]), str(found["h2"])))
    return hashlib.sha256(text.encode()).hexdigest()


_COMMITS = "seq bigint, model string, horizon string, digest string, state string"


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_COMMITS).json(f"{path}/_commits")
    except AnalysisException:  # nothing committed yet
        return None


def last_commit(spark: SparkSession, path: str, model: str, horizon: str) -> tuple[int, str | None, str | None]:
    """Number, digest and state of the newest entry on this model and horizon; ``(0, None, None)`` without one."""
    log = _commits(spark, path)
    mine = None if log is None else log.where((F.col("model") == model) & (F.col("horizon") == horizon))
    last = None if mine is None else mine.agg(F.max_by(F.struct("seq", "digest", "state"), "seq").alias("l")).first()["l"]
    return (0, None, None) if last is None else (last["seq"], last["digest"], last["state"])


def _commit(spark: SparkSession, path: str, entry: tuple) -> None:
    spark.createDataFrame([entry], _COMMITS).coalesce(1).write.mode("append").json(f"{path}/_commits")


def save_predictions(
    truth: DataFrame,
    forecast: DataFrame,
    path: str,
    model: str,
    horizon: str = "h=1",
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    if_exists: str = "overwrite",
    inputs: Sequence[DataFrame] | None = None,
    parameters: Mapping[str, object] | None = None,
) -> str:
    """Write one model's forecasts of one horizon aligned to the truth's timestamps.

    Only that model's and horizon's partition is replaced. ``if_exists='reuse'`` keeps a stored result
    of the same model and horizon, whatever it was made from, and skips the computation.
    ``if_exists='unchanged'`` keeps it only if the log beside the table says that a write of the same inputs
    and ``parameters`` was finished: ``inputs`` are the tables the forecast was made from (default: truth and
    forecast themselves), compared by :func:`content_digest`. Writes that are logged note their start before
    the first row and their end after the last, so an interrupted one is done again. One writer at a time
    per model and horizon.
    """
    if if_exists not in ("overwrite", "reuse", "unchanged"):
        raise ValueError(f"if_exists must be 'overwrite', 'reuse' or 'unchanged', not {if_exists!r}")
    spark = truth.sparkSession
    if if_exists == "reuse" and _stored(spark, path, model, horizon):
        return path
    names = as_keys(keys)
    number, known, state = last_commit(spark, path, model, horizon)
    digest = None
    if if_exists == "unchanged":
        tables = [content_digest(df) for df in (inputs if inputs is not None else (truth, forecast))]
        settings = json.dumps([tables, names, ts, dict(parameters or {})], sort_keys=True, default=str)
        digest = hashlib.sha256(settings.encode()).hexdigest()
        if (known, state) == (digest, "finished"):
            return path
    logged = digest is not None or number > 0
    if logged:  # a plain overwrite of a logged result is logged as well: it is no longer what the log says
        _commit(spark, path, (number + 1, model, horizon, digest, "started"))
    aligned = align_predictions(truth.select(*names, ts, "y_true"), forecast, names, ts)
    rows = aligned.select(*names, ts, "y_true", "y_pred", F.lit(model).alias("model"), F.lit(horizon).alias("horizon"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "horizon").parquet(path)
    if logged:
        _commit(spark, path, (number + 2, model, horizon, digest, "finished"))
    return path


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The long prediction table; filters on ``model`` and ``horizon`` prune partitions. Both are text,
    also where their values look like numbers."""
    names = ("model", "horizon")
    fields = [StructField(f.name, StringType() if f.name in names else f.dataType) for f in spark.read.parquet(path).schema]
    return spark.read.schema(StructType(fields)).parquet(path)


def save_summary(df: DataFrame, path: str) -> str:
    """Write a nested summary as JSON lines."""
    df.write.mode("overwrite").json(path)
    return path


def read_summary(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a JSON summary with its known schema."""
    return spark.read.schema(schema).json(path)


def save_model(model: PipelineModel, path: str) -> str:
    """Store a fitted pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)


def prediction_differences(
    stored: DataFrame,
    fresh: DataFrame,
    keys: str | Sequence[str] = "series_id",
    ts: str = "ts",
    rtol: float = 1e-4,
    atol: float = 1e-4,
) -> DataFrame:
    """Rows compared and rows where a reloaded model disagrees with stored forecasts, over all rows."""
    names = as_keys(keys)
    a = stored.select(*names, ts, F.col("y_pred").alias("__a"))
    b = fresh.select(*names, ts, F.col("y_pred").alias("__b"))
    joined = a.join(b, [*names, ts], "full")
    close = F.abs(F.col("__a") - F.col("__b")) <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("__b"))
    return joined.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.coalesce(close, F.lit(False))).alias("n_different"))
