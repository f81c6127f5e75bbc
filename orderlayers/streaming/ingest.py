"""Order files into the raw layer as bounded micro-batches."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from orderlayers import schema as S
from orderlayers.operators.counts import rates
from orderlayers.operators.envelope import pack
from orderlayers.operators.numbering import file_base_name, number_rows, with_row_places
from orderlayers.plans.ingest import check_run_id, numbered_rows
from orderlayers.session import pinned_splits, scratch_path
from orderlayers.sources.order_files import (
    CSV_OPTIONS,
    conform,
    literal_path,
    scans_by_header,
)
from orderlayers.sources.raw_layer import raw_path, replace_stream_load
from orderlayers.sources.reports import (
    append_report,
    read_batch_reports,
    replace_batch_report,
)

ENGINE = "pyspark_stream"

# Input of one micro-batch, unless a number of files bounds it.
BATCH_BYTES = 1 << 30


def _bounded(
    reader: DataStreamReader, max_files: int | None, max_bytes: int | None
) -> DataStreamReader:
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def stream_files(
    spark: SparkSession,
    directory: str,
    max_files: int | None = None,
    max_bytes: int | None = BATCH_BYTES,
) -> DataFrame:
    """The paths of new files of a directory as a stream; the files are listed, not read.

    Their sizes bound a micro-batch as they do in ``stream_orders``.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    return _bounded(reader, max_files, max_bytes).load(directory).select("path")


def stream_orders(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = S.RAW_SCHEMA,
    max_files: int | None = None,
    max_bytes: int | None = BATCH_BYTES,
    **options: str,
) -> DataFrame:
    """New order files of a directory as a stream, a bounded amount per micro-batch."""
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS, **options)
    return _bounded(reader, max_files, max_bytes).csv(directory).select(
        "*",
        F.col("_metadata.file_path").alias("__path"),
        file_base_name().alias("__name"),
        F.col("_metadata.file_block_start").alias("__block"),
    )


def ingest_stream(
    spark: SparkSession,
    directory: str,
    base: str,
    run_id: str,
    by_header: bool = False,
    max_files: int | None = None,
    max_bytes: int | None = BATCH_BYTES,
    on_stored: Callable[[int], None] | None = None,
) -> dict:
    """Take in whatever files the run has not yet seen, then report the run so far.

    Each micro-batch goes to a folder of its own which a retry replaces, and its metrics
    row likewise, so a run resumed from its checkpoint loads nothing twice. A failing
    batch fails the run; nothing is skipped. ``on_stored`` is called with the number of each batch
    once its rows are stored; if it raises, the batch fails. With ``by_header`` the stream is one
    of file names, and each batch reads its files by the header that each of them has.
    """
    check_run_id(run_id)
    started = time.monotonic()
    raw = raw_path(spark, base)

    def load(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        session = batch.sparkSession
        sizes = scratch_path(session, "split-sizes")
        if by_header:
            files = [literal_path(row["path"]) for row in batch.collect()]
            rows = numbered_rows(scans_by_header(session, files), sizes)
        else:
            rows = number_rows(with_row_places(batch), sizes)
            rows = conform(rows, "__name", "source_row_number")
        envelope = pack(rows, run_id, ENGINE, F.col("__name"), F.col("source_row_number"))
        replace_stream_load(envelope, raw, run_id, batch_id)
        if on_stored:
            on_stored(batch_id)
        loaded = session.read.parquet(sizes).agg(F.sum("__rows")).first()[0] or 0
        seconds, rate = rates(loaded, time.monotonic() - began)
        report = {
            "run_id": run_id,
            "batch_id": batch_id,
            "rows": loaded,
            "seconds": seconds,
            "rows_per_second": rate,
        }
        replace_batch_report(session, base, report)

    source = stream_files if by_header else stream_orders
    with pinned_splits(spark):
        stream = source(spark, directory, max_files=max_files, max_bytes=max_bytes)
        query = (
            stream.writeStream.foreachBatch(load)
            .option("checkpointLocation", f"{base}/stream_checkpoints/{run_id}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    totals = (
        read_batch_reports(spark, base, run_id)
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("rows").alias("batches"))
        .first()
    )
    seconds, throughput = rates(totals["rows"], time.monotonic() - started)
    report = {
        "stage": "ingest",
        "run_id": run_id,
        "engine_used": ENGINE,
        "rows_read": totals["rows"],
        "raw_loaded": totals["rows"],
        "elapsed_seconds": seconds,
        "throughput": throughput,
        "batch_size": max_files,
        "batches": totals["batches"],
    }
    append_report(spark, base, report)
    return report
