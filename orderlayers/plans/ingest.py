"""Batch ingest: order files into the raw layer."""

from __future__ import annotations

import re
import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlayers.operators.counts import rates
from orderlayers.operators.envelope import pack
from orderlayers.operators.numbering import (
    POSITION,
    SPLIT,
    file_base_name,
    number_rows,
    with_positions,
)
from orderlayers.session import pinned_splits, scratch_path
from orderlayers.sources.inventory import LARGE_FILE_ENGINE, file_inventory
from orderlayers.sources.order_files import conform, read_orders, scans_by_header
from orderlayers.sources.raw_layer import append_raw, raw_path
from orderlayers.sources.reports import append_report

# Run ids name folders.
RUN_ID = re.compile(r"[A-Za-z0-9_.-]+")


def check_run_id(run_id: str) -> None:
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"run id may hold letters, digits, dot, dash, underscore: {run_id!r}")


def numbered_rows(
    scans: list[DataFrame], scratch: str | None, number: str = "source_row_number"
) -> DataFrame:
    """The declared fields of all scans with ``__name`` and a row number.

    Numbers are 1, 2, 3, … per file, the sizes of splits being written to ``scratch``;
    without it they are unique through all scans, with gaps.
    """
    if scratch is None:
        named = [scan.select("*", file_base_name().alias("__name")) for scan in scans]
        rows = reduce(DataFrame.union, [conform(scan, "__name") for scan in named])
        return rows.select("*", F.monotonically_increasing_id().alias(number))
    placed = [conform(with_positions(scan), "__name", *SPLIT, POSITION) for scan in scans]
    return number_rows(reduce(DataFrame.union, placed), scratch, number)


def ingest_files(
    spark: SparkSession,
    path: str,
    base: str,
    run_id: str,
    by_header: bool = False,
    contiguous: bool = True,
    multi_line: bool = False,
) -> dict:
    """Append every row of the files at ``path`` to the raw layer and report the run.

    ``contiguous`` numbers each file's rows 1, 2, 3, … at the price of a second scan that
    only counts; without it numbers are unique, with gaps, and come free. ``by_header``
    places fields by the names in the header instead of by position. The row count is
    observed while writing. Any failure raises.
    """
    check_run_id(run_id)
    started = time.monotonic()
    files = (
        file_inventory(spark, path)
        .agg(
            F.min("file_name").alias("name"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("size_mb"), F.lit(0.0)).alias("size_mb"),
        )
        .first()
    )
    with pinned_splits(spark):
        if by_header:
            scans = scans_by_header(spark, path, multi_line)
        else:
            scans = [read_orders(spark, path, multi_line=multi_line)]
        partitions = sum(scan.rdd.getNumPartitions() for scan in scans)
        rows = numbered_rows(scans, scratch_path(spark, "split-sizes") if contiguous else None)
        envelope = pack(
            rows, run_id, LARGE_FILE_ENGINE, F.col("__name"), F.col("source_row_number")
        )
        written = Observation()
        append_raw(
            envelope.observe(written, F.count(F.lit(1)).alias("rows")), raw_path(spark, base)
        )
    loaded = written.get["rows"]
    seconds, throughput = rates(loaded, time.monotonic() - started)
    report = {
        "stage": "ingest",
        "run_id": run_id,
        "file_name": files["name"],
        "source_file_count": files["files"],
        "file_size_mb": round(files["size_mb"], 2),
        "engine_used": LARGE_FILE_ENGINE,
        "rows_read": loaded,
        "raw_loaded": loaded,
        "elapsed_seconds": seconds,
        "throughput": throughput,
        "input_partitions": partitions,
    }
    append_report(spark, base, report)
    return report
