"""Run reports as an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers import schema as S
from orderlayers.sources.frames import one_row, read_or_empty

_READ = T.StructType([*S.RUN_REPORT.fields, *S.LEGACY_REPORT_FIELDS.fields])


def _reports_path(base: str) -> str:
    return f"{base.rstrip('/')}/run_metrics"


def _batch_reports_path(base: str) -> str:
    return f"{base.rstrip('/')}/batch_metrics"


def append_report(spark: SparkSession, base: str, report: dict) -> None:
    """Append one run's report; fields it does not name are NULL."""
    row = one_row(spark, S.RUN_REPORT, {"finished_at": F.current_timestamp(), **report})
    row.write.mode("append").json(_reports_path(base))


def replace_batch_report(spark: SparkSession, base: str, report: dict) -> None:
    """Write one micro-batch's metrics row, replacing what a lost try left there."""
    row = one_row(spark, S.BATCH_REPORT, {"finished_at": F.current_timestamp(), **report})
    folder = f"run-{report['run_id']}/batch-{report['batch_id']}"
    row.write.mode("overwrite").json(f"{_batch_reports_path(base)}/{folder}")


def unify_reports(df: DataFrame) -> DataFrame:
    """Older field names folded into today's, with defaults for what is absent."""
    return df.withColumns(
        {
            "engine_used": F.coalesce("engine_used", "engine", F.lit("N/A")),
            "run_id": F.coalesce("run_id", F.lit("N/A")),
            "file_name": F.coalesce("file_name", "source_file", F.lit("N/A")),
            "rows_read": F.coalesce("rows_read", "raw_loaded", F.lit(0)),
            "valid_count": F.coalesce("valid_count", F.lit(0)),
            "corrected_count": F.coalesce("corrected_count", F.lit(0)),
            "quarantine_count": F.coalesce("quarantine_count", F.lit(0)),
            "elapsed_seconds": F.coalesce("elapsed_seconds", "elapsed_time", F.lit(0.0)),
            "throughput": F.coalesce("throughput", F.lit(0.0)),
        }
    ).select(*S.RUN_REPORT.names)


def read_reports(spark: SparkSession, base: str) -> DataFrame:
    """All reports of the table under ``base``; none yet is an empty frame, a damaged one raises."""
    reader = spark.read.option("mode", "FAILFAST")
    return unify_reports(read_or_empty(spark, reader, "json", _reports_path(base), _READ))


def read_report_file(spark: SparkSession, path: str) -> DataFrame:
    """Reports from a JSON document holding a list of them, or a single one."""
    reader = spark.read.schema(_READ).option("multiLine", True).option("mode", "FAILFAST")
    return unify_reports(reader.json(path))


def latest_report(reports: DataFrame) -> DataFrame:
    """The report finished last; runs without an end time come before all others."""
    order = F.struct("finished_at", "run_id")
    newest = F.max_by(F.struct("*"), order).alias("newest")
    return reports.agg(newest).filter(F.col("newest").isNotNull()).select("newest.*")


def read_batch_reports(spark: SparkSession, base: str, run_id: str | None = None) -> DataFrame:
    """One row per micro-batch of streaming ingest."""
    reader = spark.read.option("recursiveFileLookup", True).option("mode", "FAILFAST")
    rows = read_or_empty(spark, reader, "json", _batch_reports_path(base), S.BATCH_REPORT)
    return rows if run_id is None else rows.filter(F.col("run_id") == run_id)
