"""First rows of an order file as a smaller file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators.numbering import number_rows, with_positions
from orderlayers.session import pinned_splits, scratch_path
from orderlayers.sources.inventory import file_inventory
from orderlayers.sources.order_files import read_orders, write_orders_csv

# Fixed value: rows in a sample unless said otherwise.
SAMPLE_ROWS = 100_000

ROWS_PER_FILE = 1_000_000


def _first_files(spark: SparkSession, path: str, rows: int) -> list[str]:
    """The first files by path that hold ``rows`` rows together, or all there are.

    Rows are counted in growing groups of files, so what lies behind the sample is not read.
    """
    files = file_inventory(spark, path)
    ordered = files.orderBy("path").select("path")
    taken = 1
    while True:
        names = [row["path"] for row in ordered.limit(taken).collect()]
        if len(names) < taken or read_orders(spark, names).count() >= rows:
            return names
        taken *= 4


def sample_rows(spark: SparkSession, path: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``rows`` rows in file order, files by path, with their number.

    The reader drops blank lines before numbering and replaces invalid bytes.
    """
    numbered = number_rows(
        with_positions(read_orders(spark, _first_files(spark, path, rows))),
        scratch_path(spark, "split-sizes"),
        per_file=False,
    )
    return numbered.filter(F.col("source_row_number") <= rows)


def write_sample(
    spark: SparkSession, path: str, output: str, rows: int = SAMPLE_ROWS
) -> None:
    """Write the first rows as CSV in file order, each part under the header."""
    with pinned_splits(spark):
        first = sample_rows(spark, path, rows)
        parts = max(1, -(-rows // ROWS_PER_FILE))
        ordered = first.repartitionByRange(parts, "source_row_number").sortWithinPartitions(
            "source_row_number"
        )
        write_orders_csv(ordered.select(*S.ORDER_FIELDS), output)
