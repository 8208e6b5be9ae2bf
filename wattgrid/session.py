"""Session defaults for local runs, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


# HotSpot leaves methods above this size uncompiled. Generated code of wide projections (seven
# meter channels, a week of lagged blocks) passes it, and then runs several times slower than
# Spark's split, operator-at-a-time code. With the limit Spark picks the latter for such steps.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = "8000"
SPARK_DEFAULT_BYTES = "65535"


def tuned(spark: SparkSession) -> SparkSession:
    """Set the method limit on a session that still has Spark's default."""
    if spark.conf.get(METHOD_LIMIT) == SPARK_DEFAULT_BYTES:
        spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(METHOD_LIMIT, COMPILED_BYTES)
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where the setting is unset, a folder inside the
    warehouse, which driver and executors share as well."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Store a stage in the shared folder and cut its lineage, for results that are read several
    times. Parquet, so that each reader takes only the columns it needs."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Empty the stages that ``df`` reads, once everything made from them is stored itself. Keeps a chain of
    stages from holding the disk of all of them; nothing may read ``df`` afterwards."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if folder.rsplit("/", 1)[1].startswith("stage-"):
            spark.range(0, 0, 1, 1).write.mode("overwrite").parquet(folder)
