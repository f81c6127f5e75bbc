"""Sizes of input files and the ingest mode each one calls for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlayers.operators.numbering import file_base_name

# Largest file, in MB, for the small-file mode; names of the modes.
SMALL_FILE_MB = 200.0
SMALL_FILE_ENGINE = "python_batch"
LARGE_FILE_ENGINE = "pyspark"


def file_inventory(
    spark: SparkSession, path: str, threshold_mb: float = SMALL_FILE_MB
) -> DataFrame:
    """One row per file: name, bytes, MB and the mode its size calls for.

    The content column is pruned, so only the listing is read. A missing path raises.
    """
    size_mb = F.col("length") / F.lit(1024 * 1024)
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            file_base_name().alias("file_name"),
            "path",
            "length",
            size_mb.alias("size_mb"),
            F.when(size_mb <= threshold_mb, SMALL_FILE_ENGINE)
            .otherwise(LARGE_FILE_ENGINE)
            .alias("engine"),
        )
    )
