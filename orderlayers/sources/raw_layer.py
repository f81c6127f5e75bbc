"""The append-only raw layer."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers import schema as S
from orderlayers.session import setting
from orderlayers.sources.frames import no_rows, path_exists, read_or_empty
from orderlayers.sources.publications import current_version, version_path

FIRST_VERSION = "v-first"
BATCH_LOAD = "batch"

_STORED = T.StructType(
    [
        *[field for field in S.RAW_ENVELOPE.fields if field.name != "run_id"],
        T.StructField("run_id", T.StringType()),
        T.StructField("load", T.StringType()),
    ]
)


def raw_path(spark: SparkSession, base: str) -> str:
    """Folder of the current raw data; only a reset moves it."""
    current = current_version(spark, base, S.RAW)
    return version_path(base, S.RAW, current["version"] if current else FIRST_VERSION)


def append_raw(envelope: DataFrame, path: str) -> None:
    """Append rows as they are; loading the same input again adds them again.

    Each task keeps a file open for its run, and so need not sort its wide rows by run.
    """
    with setting(envelope.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", 2):
        (
            envelope.withColumn("load", F.lit(BATCH_LOAD))
            .write.mode("append")
            .partitionBy("run_id", "load")
            .parquet(path)
        )


def replace_stream_load(envelope: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Write one micro-batch to a folder of its own, replacing what a lost try left there."""
    (
        envelope.drop("run_id")
        .write.mode("overwrite")
        .parquet(f"{path}/run_id={run_id}/load=stream-{batch_id}")
    )


def read_raw(
    spark: SparkSession, base: str, run_ids: Collection[str] | None = None
) -> DataFrame:
    """All raw rows, or those of some runs: their folders alone are listed and read.

    A run that has no folder has no rows.
    """
    path = raw_path(spark, base)
    if run_ids is None:
        rows = read_or_empty(spark, spark.read, "parquet", path, _STORED)
    else:
        folders = [f"{path}/run_id={run_id}" for run_id in dict.fromkeys(run_ids)]
        folders = [folder for folder in folders if path_exists(spark, folder)]
        if folders:
            rows = spark.read.schema(_STORED).option("basePath", path).parquet(*folders)
        else:
            rows = no_rows(spark, _STORED)
    return rows.select(*S.RAW_ENVELOPE.names)
