"""Small frames made of literals, and reads of paths that may not exist yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, dict):
        return F.create_map(*[F.lit(x) for pair in value.items() for x in pair]).cast(kind)
    return F.lit(value).cast(kind)


def one_row(spark: SparkSession, schema: T.StructType, values: dict) -> DataFrame:
    """A single row; fields without a value are NULL."""
    return spark.range(0, 1, 1, 1).select(
        *[_literal(values.get(f.name), f.dataType).alias(f.name) for f in schema]
    )


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that Catalyst knows is empty, so joins with it vanish."""
    return one_row(spark, schema, {}).filter(F.lit(False))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_or_empty(
    spark: SparkSession, reader: DataFrameReader, form: str, path: str, schema: T.StructType
) -> DataFrame:
    """Read ``path``; a path that does not exist is an empty frame, any failure raises."""
    if not path_exists(spark, path):
        return no_rows(spark, schema)
    return reader.schema(schema).format(form).load(path)
