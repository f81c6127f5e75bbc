"""ELT: raw layer to validated and quarantine layers."""

from __future__ import annotations

import time
from collections.abc import Collection

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from orderlayers import schema as S
from orderlayers.operators.classify import classify, routed
from orderlayers.operators.counts import rates, source_summary
from orderlayers.session import scratch_path, setting
from orderlayers.sources.frames import remove_path
from orderlayers.sources.keyed_layers import upsert
from orderlayers.sources.ledger import new_runs, record_merged
from orderlayers.sources.raw_layer import read_raw
from orderlayers.sources.reports import append_report

ENGINE = "pyspark_elt"

# A task finds the newest rows of one piece of the work table by sorting it; this holds a few hundred
# MB of rows, however well they are packed in the file.
PIECE_BYTES = 32 << 20


def _tallies(statuses: Collection[str]) -> dict:
    status = F.col("record_status")
    return {
        **{name: status == name for name in statuses},
        "null_date_count": F.col("order_date").isNull(),
    }


def run_elt(
    spark: SparkSession,
    base: str,
    run_id: str,
    run_ids: Collection[str] | None = None,
    storage: StorageLevel | None = None,
    buckets: int | None = None,
    only_new: bool = False,
) -> dict | None:
    """Clean, audit and classify raw rows, upsert both layers, report the run.

    The whole raw layer is read unless ``run_ids`` names the ingest runs to take. Without
    raw rows nothing happens and nothing is reported.

    With ``only_new`` the ledger tells which of those runs were merged before, with the files they
    have now; they are not read. Stored rows that are newer than a run's stay, so the layers
    hold what one ELT over all of these runs would give, whatever the order they are merged in.

    The raw rows are scanned and classified once, into a work table with a folder for each
    layer; the upserts read their own folder of it and count what they pass on. The table goes
    when they are done. ``storage`` keeps the classified rows in Spark's storage instead; that
    pays while they fit the cluster's memory.
    """
    started = time.monotonic()
    runs = []
    if only_new:
        runs = [run for run in new_runs(spark, base) if run_ids is None or run[0] in run_ids]
        if not runs:
            return None
        run_ids = [run[0] for run in runs]
    rows = routed(classify(read_raw(spark, base, run_ids)))
    if storage is None:
        work = scratch_path(spark, "elt-routed")
        # Each task keeps one open file a layer, and so need not sort its wide rows by layer.
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", 2):
            rows.write.partitionBy("layer").option("parquet.block.size", PIECE_BYTES).parquet(work)
        kept = spark.read.schema(rows.schema).parquet(work)
    else:
        kept = rows.persist(storage)
    try:
        source = source_summary(kept).first()
        if source["rows_read"] == 0:
            record_merged(spark, base, runs)
            return None
        read = source["rows_read"]
        bad, good = (kept.filter(F.col("layer") == x).drop("layer") for x in (S.QUARANTINE, S.VALIDATED))
        with setting(spark, "spark.sql.files.maxPartitionBytes", PIECE_BYTES):
            held = upsert(
                spark, base, S.QUARANTINE, bad, run_id, _tallies(S.QUARANTINE_STATUSES), buckets, read, only_new
            )
            passed = upsert(
                spark, base, S.VALIDATED, good, run_id, _tallies(S.ACCEPTED_STATUSES), buckets, read, only_new
            )
        record_merged(spark, base, runs)
    finally:
        if storage is None:
            remove_path(spark, work)
        else:
            kept.unpersist()

    reasons = {name: held[name] for name in S.QUARANTINE_STATUSES if held[name]}
    seconds, throughput = rates(read, time.monotonic() - started)
    report = {
        "stage": "elt",
        "run_id": run_id,
        "file_name": source["file_name"],
        "source_file_count": source["source_file_count"],
        "file_size_mb": 0.0,
        "engine_used": ENGINE,
        "rows_read": read,
        "raw_loaded": read,
        "valid_count": passed[S.VALID],
        "corrected_count": passed[S.CORRECTED],
        "quarantine_count": sum(reasons.values()),
        "error_case_counts": reasons,
        "null_date_count": passed["null_date_count"] + held["null_date_count"],
        "inserted_count": passed["inserted_count"],
        "updated_count": passed["updated_count"],
        "unchanged_count": passed["unchanged_count"],
        "inserted_keys": passed["inserted_keys"],
        "updated_keys": passed["updated_keys"],
        "quarantine_keys": held["incoming_keys"],
        "elapsed_seconds": seconds,
        "throughput": throughput,
        "partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    check_report(report)
    append_report(spark, base, report)
    return report


def check_report(report: dict) -> None:
    """Every row read is accounted for once, by status and by what became of it."""
    kept = report["valid_count"] + report["corrected_count"]
    if report["rows_read"] != kept + report["quarantine_count"]:
        raise RuntimeError(f"rows read do not add up by status: {report}")
    if kept != report["inserted_count"] + report["updated_count"]:
        raise RuntimeError(f"accepted rows do not add up by effect: {report}")
