"""Delimited order files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers import schema as S
from orderlayers.operators.headers import named, repair_headers
from orderlayers.session import setting

# Doubled quotes inside a quoted field are one quote; the default backslash escape would
# cut such a field at its first comma.
CSV_OPTIONS = {"header": "true", "escape": '"'}

GLOB_CHARACTERS = "{}[]*?\\"

# Larger than files are; sums over very many files still fit a long.
WHOLE_FILE = 1 << 38

# The writer trims fields unless told not to.
CSV_WRITE_OPTIONS = {
    **CSV_OPTIONS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_orders(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = S.RAW_SCHEMA,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Order files under the declared schema: by position, header skipped, all strings.

    ``multi_line`` lets a quoted field span lines, at the price of unsplittable files.
    """
    return (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS, **options)
        .option("multiLine", multi_line)
        .csv(path)
    )


def header_schema(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """The columns a file's header names, as strings; reads the header line alone."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def literal_path(path: str) -> str:
    """A path that readers take as it is, whatever glob characters are in it."""
    return "".join("\\" + c if c in GLOB_CHARACTERS else c for c in path)


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, block, line) for the first line that is not blank in each split of the files.

    Run it under ``one_file_a_task``: a task then opens one file and stops at that line. Spark
    has no expression that stops reading, so this takes a Python task, over a few lines a file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )
    blank = "".join(map(chr, range(33)))

    def first(batches):
        for batch in batches:
            for k, line in enumerate(batch.column(2).to_pylist()):
                if line.strip(blank):
                    yield batch.slice(k, 1)
                    return

    return lines.mapInArrow(first, "path string, block long, line string")


@contextmanager
def one_file_a_task(spark: SparkSession) -> Iterator[None]:
    """Splits of whole files, one for each task, whose lines reach Python a few at a time."""
    with ExitStack() as stack:
        for key, value in {
            "spark.sql.files.maxPartitionBytes": WHOLE_FILE,
            "spark.sql.files.openCostInBytes": WHOLE_FILE,
            "spark.sql.files.maxPartitionNum": (1 << 31) - 1,
            "spark.sql.execution.arrow.maxRecordsPerBatch": 16,
        }.items():
            stack.enter_context(setting(spark, key, value))
        yield


def scans_by_header(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> list[DataFrame]:
    """One scan for each header among the files, its columns named as that header names them.

    Files under one header share a scan, so there are as many scans as different header
    lines, and a single one over ``path`` where all are the same. The driver gets the names of
    the files, which it lists anyway, and a hash of each header. A header is one line. A file
    that doesn't bear the header it was sorted under fails the read.
    """
    with one_file_a_task(spark):
        rows = (
            first_lines(spark, path)
            .filter("block = 0")
            .select("path", F.xxhash64("line").alias("header"))
            .collect()
        )
    groups: dict[int, list[str]] = {}
    for row in sorted(rows):
        groups.setdefault(row["header"], []).append(literal_path(unquote(row["path"])))
    if not groups:
        return [read_orders(spark, path, multi_line=multi_line)]
    places = list(groups.values()) if len(groups) > 1 else [path]
    return [
        read_orders(
            spark, place, header_schema(spark, files[0]), multi_line, enforceSchema="false"
        )
        for place, files in zip(places, groups.values(), strict=True)
    ]


def read_orders_by_header(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Order files by the names in each one's header, in any column order.

    A column that a file doesn't have is NULL in its rows.
    """
    scans = scans_by_header(spark, path, multi_line)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def conform(df: DataFrame, *extras: str) -> DataFrame:
    """The declared fields, by repaired name, missing ones NULL; others in the map ``extra``."""
    rows = repair_headers(df)
    unknown = [c for c in rows.columns if c not in S.ORDER_FIELDS and c not in extras]
    pairs = [part for name in unknown for part in (F.lit(name), named(name).cast("string"))]
    extra = F.create_map(*pairs) if pairs else F.lit(None)
    return rows.select(
        *[
            F.col(field) if field in rows.columns else F.lit(None).cast("string").alias(field)
            for field in S.ORDER_FIELDS
        ],
        extra.cast(S.EXTRA.dataType).alias(S.EXTRA.name),
        *extras,
    )


def write_orders_csv(df: DataFrame, path: str) -> None:
    """Write CSV parts, each with its header, that read back field for field.

    Empty strings come back as NULL, as from any file.
    """
    df.write.options(**CSV_WRITE_OPTIONS).csv(path)
