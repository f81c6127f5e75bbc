"""Validated and quarantine layers: one row per key, replaced by upsert.

A layer's files are bucketed by key and lie in a folder for each version and bucket. Reading
them as a bucketed table lets the merge join use the stored layer without shuffling it. An
upsert reads and writes the buckets that its keys fall into and leaves the others where they
are: the publication says which version holds each bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers import schema as S
from orderlayers.operators.merge import (
    MERGE_FLAGS,
    latest_per_key,
    merge_counts,
    merge_latest,
)
from orderlayers.session import setting
from orderlayers.sources.frames import no_rows
from orderlayers.sources.publications import (
    bucket_holders,
    current_version,
    data_path,
    new_version,
    publish,
)

# A layer gets a bucket for this many rows, a few hundred MB, however many that makes (Spark
# itself allows spark.sql.sources.bucketing.maxBuckets, 100,000 unless raised).
ROWS_PER_BUCKET = 1_000_000
# A small layer gets as many buckets as there are shuffle partitions, to use all cores, but
# none for fewer rows than this.
LEAST_ROWS = 5_000
# The folders that a layer's files lie in.
PLACES = (T.StructField("layer_version", T.StringType()), T.StructField("layer_bucket", T.IntegerType()))


def bucket_count(rows: int | None, partitions: int, stored: int = 0) -> int:
    """Buckets for a layer that grows by ``rows``; it never loses buckets."""
    if rows is None:
        return max(partitions, stored)
    return max(-(-rows // ROWS_PER_BUCKET), min(partitions, -(-rows // LEAST_ROWS)), stored, 1)


def bucket_of(buckets: int) -> Column:
    """The bucket of a key, as Spark itself places it."""
    return F.pmod(F.hash("_id"), F.lit(buckets))


@contextmanager
def _bucketed_table(spark: SparkSession, path: str, buckets: int) -> Iterator[str]:
    """A name for the bucketed files under ``path``; dropping the name keeps the files."""
    name = f"orderlayers_{uuid.uuid4().hex}"
    fields = [*S.LAYER_SCHEMA, *PLACES]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    location = path.replace("'", "\\'")
    # Folders are found by listing them; a session catalog knows of none.
    with setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(f.name for f in PLACES)}) "
            f"CLUSTERED BY (_id) SORTED BY (_id) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_layer(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """Current contents of a layer; a layer never written is empty."""
    return read_buckets(spark, base, layer, current_version(spark, base, layer))


def _listed(values: Collection) -> Column:
    """A constant list that is looked up by place; one text, since there may be many thousands."""
    return F.split(F.lit(",".join(map(str, values))), ",")


def _among(place: Column, places: Collection[int], buckets: int) -> Column:
    """Whether a bucket is one of ``places``."""
    if len(places) == buckets:
        return F.lit(True)
    chosen = set(places)
    return F.get(_listed([int(k in chosen) for k in range(buckets)]), place) == "1"


def holder_of(version: Row, place: Column) -> Column:
    """The version whose folder holds a bucket."""
    return F.get(
        _listed(version["holders"].split(",")),
        F.get(_listed(version["held_by"].split(",")), place).cast("int"),
    )


def read_buckets(
    spark: SparkSession, base: str, layer: str, version: Row | None, places: Collection[int] | None = None
) -> DataFrame:
    """A version's rows, or those in the buckets ``places``: only their folders are read."""
    if version is None or version["buckets"] == 0:
        return no_rows(spark, S.LAYER_SCHEMA)
    buckets = version["buckets"]
    holder = holder_of(version, F.col("layer_bucket"))
    with _bucketed_table(spark, data_path(base, layer), buckets) as name:
        rows = spark.table(name).filter(F.col("layer_version") == holder)
        if places is not None:
            rows = rows.filter(_among(F.col("layer_bucket"), places, buckets))
        return rows.select(*S.LAYER_SCHEMA.names)


def existing_keys(spark: SparkSession, base: str, layer: str) -> DataFrame:
    return read_layer(spark, base, layer).select("_id")


def upsert(
    spark: SparkSession,
    base: str,
    layer: str,
    incoming: DataFrame,
    run_id: str | None = None,
    tallies: Mapping[str, Column] | None = None,
    buckets: int | None = None,
    expected_rows: int | None = None,
    keep_newer: bool = False,
) -> dict[str, int]:
    """Replace the layer's rows by the newest incoming row of each key; return counts.

    With ``keep_newer`` a stored row that is newer than the incoming one stays.

    Only the buckets that incoming keys fall into are read and written anew, whatever the size
    of the layer; a look at the keys alone tells which they are. An empty layer has no bucket to
    spare, so its rows are read once, without that look. The counts come out of the write
    itself, observed after the last shuffle, where a task that is run again is not counted again.
    Where no row comes in, nothing is written. The merge shuffles to as many partitions as
    there are buckets, so the stored rows stay where they are and only the incoming ones move,
    once; a change of ``buckets`` moves the whole layer. Without ``buckets``, ``bucket_count`` sets
    them by ``expected_rows``.
    """
    names = tuple(tallies or ())
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    current = current_version(spark, base, layer)
    stored = current["buckets"] if current else 0
    if buckets is None:
        buckets = bucket_count(expected_rows, partitions, stored)
    if stored:
        touched = [row[0] for row in incoming.select(bucket_of(buckets)).distinct().collect()]
    else:
        touched = list(range(buckets))
    rows_before = current["rows"] if stored else 0
    if not touched:
        return _nothing_came(rows_before, names)
    in_place = stored == buckets
    existing = read_buckets(spark, base, layer, current, touched if in_place else None)
    merged = merge_latest(existing, latest_per_key(incoming, tallies), names, keep_newer=keep_newer)
    written = Observation()
    stray = F.count_if(F.col("__arrived") & ~_among(bucket_of(buckets), touched, buckets))
    version = new_version()
    rows = (
        merged.observe(written, *merge_counts(names), stray.alias("stray"))
        .drop(*MERGE_FLAGS, *names)
        .select(
            *S.LAYER_SCHEMA.names,
            F.lit(version).alias("layer_version"),
            bucket_of(buckets).alias("layer_bucket"),
        )
    )
    with (
        _bucketed_table(spark, data_path(base, layer), buckets) as name,
        setting(spark, "spark.sql.shuffle.partitions", buckets),
    ):
        rows.write.insertInto(name)
    counts = written.get
    if counts.pop("stray"):
        raise RuntimeError("incoming rows had other keys when they were read again")
    if not counts["incoming_keys"]:
        return _nothing_came(rows_before, names)
    counts["layer_rows"] = rows_before + counts["inserted_keys"]
    held_by = bucket_holders(current) if in_place else [version] * buckets
    for place in touched:
        held_by[place] = version
    publish(spark, base, layer, version, buckets, run_id, counts["layer_rows"], held_by)
    return counts


def _nothing_came(rows: int, names: tuple[str, ...]) -> dict[str, int]:
    """The counts of an upsert of no rows."""
    counts = dict.fromkeys(
        ("inserted_count", "updated_count", "inserted_keys", "updated_keys", "unchanged_count", "incoming_keys"), 0
    )
    return {**counts, "layer_rows": rows, **dict.fromkeys(names, 0)}


def reset_layer(spark: SparkSession, base: str, layer: str) -> None:
    """Make a layer empty by publishing a version with nothing in it."""
    publish(spark, base, layer, new_version(), 0, None)


def preview_layer(df: DataFrame, rows: int = 10, order_by: str | None = None) -> DataFrame:
    """Any few rows without their key; the same ones each time if ordered."""
    ordered = df.orderBy(order_by) if order_by else df
    return ordered.limit(rows).drop("_id")
