"""What is known of the keys in each bucket of a layer, so that lookups skip buckets.

Beside each version lie, for each bucket that it wrote, the least and the greatest key and a Bloom
filter. A filter is cut into words of 64 bits; a key sets four bits of one word, so that it is
looked up by one join row. With 16 bits a key, about one in a hundred keys that are not there
seems to be. A bucket without a filter is always read, so a lookup is right whatever is missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers.sources.frames import read_or_empty
from orderlayers.sources.keyed_layers import bucket_of, holder_of, read_buckets
from orderlayers.sources.publications import bucket_holders, current_version, key_path

BITS_PER_KEY = 16
BITS_SET = 4

VERSION = T.StructField("version", T.StringType())
RANGES = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("least", T.StringType()),
        T.StructField("greatest", T.StringType()),
        T.StructField("words", T.LongType()),
        VERSION,
    ]
)
WORDS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("word", T.LongType()),
        T.StructField("bits", T.LongType()),
        VERSION,
    ]
)


def _word(words: Column) -> Column:
    return F.pmod(F.xxhash64("_id"), words)


def _mask() -> Column:
    """The bits that a key sets in its word, from another hash than the one that chose the word."""
    spread = F.xxhash64("_id", F.lit(1))
    places = [F.shiftrightunsigned(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(BITS_SET)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return reduce(Column.bitwiseOR, bits)


def _stored(spark: SparkSession, base: str, layer: str, part: str, schema: T.StructType, versions: list[str]) -> DataFrame:
    """Ranges or words of some versions; the folders of others are not read."""
    rows = read_or_empty(spark, spark.read, "parquet", key_path(base, layer, part), schema)
    return rows.filter(F.col("version").isin(versions))


def _append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("version").parquet(path)


def write_key_filters(spark: SparkSession, base: str, layer: str) -> int:
    """Give every bucket of the current version a filter; return how many had none.

    Only the keys of those buckets are read. Ranges are written last, so a bucket has either a
    whole filter or none; a try that died leaves words that another one sets once more.
    """
    current = current_version(spark, base, layer)
    if current is None or current["buckets"] == 0:
        return 0
    buckets, holders = current["buckets"], bucket_holders(current)
    versions = sorted(set(holders))
    ranges = _stored(spark, base, layer, "ranges", RANGES, versions)
    known = {(row["version"], row["bucket"]) for row in ranges.select("version", "bucket").distinct().collect()}
    missing = [bucket for bucket, version in enumerate(holders) if (version, bucket) not in known]
    if not missing:
        return 0
    keys = read_buckets(spark, base, layer, current, missing).select(
        "_id", bucket_of(buckets).alias("bucket")
    )
    version = holder_of(current, F.col("bucket")).alias("version")
    words = F.greatest(F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / 64), F.lit(1))
    found = (
        keys.groupBy("bucket")
        .agg(F.min("_id").alias("least"), F.max("_id").alias("greatest"), words.alias("words"))
    )
    # Buckets that hold no row have a filter without bits.
    places = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).filter(F.col("bucket").isin(missing))
    sized = places.join(found, "bucket", "left").select(
        "bucket", "least", "greatest", F.coalesce("words", F.lit(1).cast("long")).alias("words"), version
    )
    bits = (
        keys.join(sized.select("bucket", "words"), "bucket")
        .groupBy("bucket", _word(F.col("words")).alias("word"))
        .agg(F.bit_or(_mask()).alias("bits"))
        .select("bucket", "word", "bits", version)
    )
    _append(bits, key_path(base, layer, "words"))
    _append(sized, key_path(base, layer, "ranges"))
    return len(missing)


def may_be_stored(spark: SparkSession, base: str, layer: str, keys: DataFrame) -> DataFrame:
    """(_id, bucket) of the distinct keys that the layer may hold; of each it holds, in any case."""
    current = current_version(spark, base, layer)
    distinct = keys.select("_id").filter(F.col("_id").isNotNull()).distinct()
    if current is None or current["buckets"] == 0:
        return distinct.select("_id", F.lit(0).alias("bucket")).filter(F.lit(False))
    versions = sorted(set(bucket_holders(current)))
    placed = distinct.select("_id", bucket_of(current["buckets"]).alias("bucket"))
    placed = placed.withColumn("version", holder_of(current, F.col("bucket")))
    ranges = _stored(spark, base, layer, "ranges", RANGES, versions).dropDuplicates(["version", "bucket"])
    known = placed.join(ranges, ["version", "bucket"], "left")
    unknown = known.filter(F.col("words").isNull()).select("_id", "bucket")
    within = known.filter(F.col("_id").between(F.col("least"), F.col("greatest"))).select(
        "_id", "bucket", "version", _word(F.col("words")).alias("word"), _mask().alias("mask")
    )
    words = _stored(spark, base, layer, "words", WORDS, versions)
    same = [within[name] == words[name] for name in ("version", "bucket", "word")]
    held = words["bits"].bitwiseAND(within["mask"]) == within["mask"]
    likely = within.join(words, [*same, held], "left_semi").select("_id", "bucket")
    return likely.unionByName(unknown)


def stored_keys_among(spark: SparkSession, base: str, layer: str, keys: DataFrame) -> DataFrame:
    """``_id`` of the layer's rows whose key is one of ``keys``.

    Buckets that hold none of them are not read, but for those that a filter takes for one that
    does; which they are is all that comes to the driver.
    """
    possible = may_be_stored(spark, base, layer, keys)
    places = [row["bucket"] for row in possible.select("bucket").distinct().collect()]
    rows = read_buckets(spark, base, layer, current_version(spark, base, layer), places)
    return rows.select("_id").join(possible.select("_id"), "_id", "left_semi")
