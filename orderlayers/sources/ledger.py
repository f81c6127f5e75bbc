"""Which raw runs have been merged into the keyed layers, so that an ELT can take new ones only.

A row is appended for each run once both layers are published. An ELT that dies before takes its
runs again, which changes nothing where the newest row of a key stays. A run is known by its
files: one that has gained files since it was merged is taken again, whole. Emptying any of the
three layers makes what was merged before void.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers import schema as S
from orderlayers.sources.frames import one_row, path_exists, read_or_empty
from orderlayers.sources.publications import publications
from orderlayers.sources.raw_layer import raw_path

LAYERS = (S.VALIDATED, S.QUARANTINE)

MERGED = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
        # Newest publication of each layer when the run had been merged.
        T.StructField("seqs", T.MapType(T.StringType(), T.LongType())),
        T.StructField("merged_at", T.TimestampType()),
    ]
)

RunFiles = tuple[str, int, int]


def _ledger_path(base: str) -> str:
    return f"{base.rstrip('/')}/merged_runs"


def raw_runs(spark: SparkSession, base: str) -> list[RunFiles]:
    """Each raw run with the number and the bytes of its files, as the file system tells them."""
    path = raw_path(spark, base)
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for entry in files.listStatus(folder):
        name, partitioned, run_id = entry.getPath().getName().partition("=")
        if entry.isDirectory() and partitioned and name == "run_id":
            held = files.getContentSummary(entry.getPath())
            found.append((run_id, held.getFileCount(), held.getLength()))
    return sorted(found)


def _newest_seq(spark: SparkSession, base: str, layer: str, resets: bool = False) -> int:
    """Number of the layer's newest publication, or of the newest that emptied it; 0 without one."""
    rows = publications(spark, base, layer)
    if resets:
        rows = rows.filter(F.col("buckets") == 0)
    return rows.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]


def merged_runs(spark: SparkSession, base: str) -> DataFrame:
    """The ledger's rows that still hold."""
    rows = read_or_empty(spark, spark.read, "json", _ledger_path(base), MERGED)
    rows = rows.filter(F.col("raw") == raw_path(spark, base))
    for layer in LAYERS:
        rows = rows.filter(F.col("seqs")[layer] >= _newest_seq(spark, base, layer, resets=True))
    return rows


def new_runs(spark: SparkSession, base: str) -> list[RunFiles]:
    """Raw runs that have not been merged with the files they have now."""
    known = {tuple(row) for row in merged_runs(spark, base).select("run_id", "files", "bytes").distinct().collect()}
    return [run for run in raw_runs(spark, base) if run not in known]


def record_merged(spark: SparkSession, base: str, runs: Iterable[RunFiles]) -> None:
    """Note runs as merged, with the files they had before they were read."""
    raw = raw_path(spark, base)
    seqs = {layer: _newest_seq(spark, base, layer) for layer in LAYERS}
    rows = [
        one_row(
            spark,
            MERGED,
            {"raw": raw, "run_id": run_id, "files": files, "bytes": size, "seqs": seqs, "merged_at": F.current_timestamp()},
        )
        for run_id, files, size in runs
    ]
    if rows:
        reduce(DataFrame.union, rows).coalesce(1).write.mode("append").json(_ledger_path(base))
