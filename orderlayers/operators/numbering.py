"""Contiguous row numbers for files, without moving the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLIT = ["__path", "__block"]
POSITION = "__position"


def file_base_name() -> F.Column:
    """Each row's file, without folders, as it is called: the reader's metadata escape it."""
    escaped = F.col("_metadata.file_name")
    plain = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(escaped, F.lit("%")), plain).otherwise(escaped)


def with_positions(df: DataFrame) -> DataFrame:
    """Attach each row's file, split and place to a frame read from files.

    Call it after any filter on lines, so that dropped lines take no number.
    """
    return with_row_places(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("__path"),
            file_base_name().alias("__name"),
            F.col("_metadata.file_block_start").alias("__block"),
        )
    )


def with_row_places(df: DataFrame) -> DataFrame:
    """Attach the place only; streams carry file and split and number each batch."""
    return df.select("*", F.monotonically_increasing_id().alias(POSITION))


def _split_key() -> F.Column:
    """One long per split, so that rows carry and look up eight bytes and no path."""
    return F.xxhash64(*SPLIT).alias("__split")


def split_sizes(df: DataFrame) -> DataFrame:
    """First place and row count of every split; reads no field of the rows."""
    return df.groupBy(*SPLIT).agg(
        F.min(POSITION).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )


def _running(column: str, window) -> F.Column:
    """Sum of all earlier rows of a window."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def number_rows(
    df: DataFrame,
    scratch: str,
    column: str = "source_row_number",
    per_file: bool = True,
) -> DataFrame:
    """Number rows from 1 in file order, per file or through all files by path.

    Rows keep their partitions, whatever the number of splits. A first pass writes each
    split's size under ``scratch``; running sums over those rows give every split its offset,
    and the offsets go to all tasks: about 40 bytes for each input split, so 32 MB for 100 TB
    in splits of 128 MB. Through all files, splits are summed within their file first, and only
    the files' totals pass through one task. A place is unique only within one layout of
    splits, so a second pass that finds another layout fails instead of numbering wrongly;
    ``session.pinned_splits`` keeps the layout.
    """
    spark = df.sparkSession
    split_sizes(df).write.parquet(scratch)
    sizes = spark.read.schema(
        "__path string, __block long, __first long, __rows long"
    ).parquet(scratch)
    in_file = _running("__rows", W.partitionBy("__path").orderBy("__block"))
    offsets = sizes.withColumn("__offset", in_file)
    if not per_file:
        files = sizes.groupBy("__path").agg(F.sum("__rows").alias("__total"))
        before = files.select("__path", _running("__total", W.orderBy("__path")).alias("__before"))
        offsets = offsets.join(before, "__path").withColumn(
            "__offset", F.col("__offset") + F.col("__before")
        )
    offsets = offsets.select(_split_key(), "__first", "__rows", "__offset")
    twice = offsets.groupBy("__split").count().filter("count > 1")
    if not twice.isEmpty():
        raise RuntimeError("two input splits have the same hash; number rows without contiguous")
    within = F.col(POSITION) - F.col("__first")
    number = F.when(
        within.between(0, F.col("__rows") - 1), F.col("__offset") + within + 1
    ).otherwise(F.raise_error("input splits changed between the two passes").cast("long"))
    return (
        df.withColumn("__split", _split_key())
        .join(F.broadcast(offsets), "__split", "left")
        .select(*[c for c in df.columns if c not in (*SPLIT, POSITION)], number.alias(column))
    )
