"""Run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers import functions as fn
from orderlayers import schema as S


def status_counts(df: DataFrame) -> DataFrame:
    """Rows read, valid, corrected and quarantined in one pass over a classified frame."""
    status = F.col("record_status")
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(status == S.VALID).alias("valid_count"),
        F.count_if(status == S.CORRECTED).alias("corrected_count"),
        F.count_if(fn.is_quarantined(status)).alias("quarantine_count"),
        F.count_if(F.col("order_date").isNull()).alias("null_date_count"),
    )


def quarantine_reasons(df: DataFrame) -> DataFrame:
    """Quarantined rows per reason."""
    return (
        df.filter(fn.is_quarantined(F.col("record_status")))
        .groupBy("record_status")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def source_summary(df: DataFrame) -> DataFrame:
    """Row count, first source file name and number of source files."""
    return (
        df.groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"),
            F.coalesce(F.min("source_file"), F.lit("unknown_file.csv")).alias("file_name"),
            F.count("source_file").alias("source_file_count"),
        )
    )


def rates(rows: int, seconds: float) -> tuple[float, float]:
    """Elapsed seconds and rows per second as reported, zero when nothing elapsed."""
    return round(seconds, 2), round(rows / seconds, 2) if seconds > 0 else 0.0
