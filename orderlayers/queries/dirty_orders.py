"""Dirty order records derived from the given orders, customer, nation, region tables.

The rules are SQL text that Spark and DuckDB read alike. In them ``k`` is the order key,
``c`` the customer key as text, ``d`` the order date as text, ``amt`` the total with two
decimals; the first matching branch decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators.envelope import pack

# The fixture's rules.
RULES = {
    "order_id": "CASE WHEN k % 97 = 5 THEN NULL WHEN k % 97 = 6 THEN '  ' "
    "ELSE 'ORD-' || cast(k AS string) END",
    "order_date": "CASE WHEN k % 19 = 3 THEN substring(d, 9, 2) || '/' || "
    "substring(d, 6, 2) || '/' || substring(d, 1, 4) "
    "WHEN k % 19 = 4 THEN 'not-a-date' WHEN k % 53 = 7 THEN '' ELSE d END",
    "status": "CASE WHEN k % 37 = 0 THEN 'unknown' WHEN k % 31 = 0 THEN ' مؤكد ' "
    "WHEN o_orderstatus = 'F' THEN 'تم التسليم' "
    "WHEN o_orderstatus = 'O' THEN 'قيد الانتظار' ELSE 'قيد الشحن' END",
    "customer_id": "CASE WHEN k % 71 = 1 THEN NULL WHEN k % 71 = 2 THEN '' ELSE 'C' || c END",
    "customer_name": "c_name",
    "customer_phone": "CASE WHEN k % 41 = 0 THEN 'n/a' "
    "WHEN k % 13 = 0 THEN '+20 ' || lpad(c, 4, '0') || ' 55555' "
    "ELSE '+2' || lpad(c, 9, '0') END",
    "customer_email": "CASE WHEN k % 43 = 0 THEN 'user.example.com' "
    "WHEN k % 17 = 0 THEN 'user' || c || '@@example.com' "
    "WHEN k % 29 = 0 THEN 'user' || c || '@example..com' "
    "ELSE 'user' || c || '@example.com' END",
    "city": "CASE WHEN k % 11 = 0 THEN ' ' || n_name || '  ' ELSE n_name END",
    "district": "r_name",
    "delivery_type": "CASE WHEN k % 3 = 0 THEN 'express' ELSE 'standard' END",
    "delivery_cost": "CASE WHEN k % 47 = 0 THEN '-5.00' "
    "ELSE cast(k % 40 AS string) || '.50' END",
    "payment_method": "CASE WHEN k % 2 = 0 THEN 'card' ELSE 'cash' END",
    "payment_status": "CASE WHEN k % 4 = 0 THEN 'pending' ELSE 'paid' END",
    "payment_amount": "amt",
    "currency": "CASE WHEN k % 23 = 0 THEN 'usd' WHEN k % 3 = 0 THEN 'USD' "
    "WHEN k % 3 = 1 THEN 'SAR' ELSE 'YER' END",
    "total_amount": "CASE WHEN k % 101 = 0 THEN 'غير معروف' WHEN k % 103 = 0 THEN '' "
    "WHEN k % 107 = 0 THEN NULL WHEN k % 109 = 0 THEN '-12.50' WHEN k % 113 = 0 THEN '0' "
    "WHEN k % 7 = 0 THEN translate(amt, '0123456789.', '٠١٢٣٤٥٦٧٨٩٫') "
    "WHEN k % 7 = 1 THEN 'SAR ' || amt WHEN k % 7 = 2 THEN amt || ' ر.س' ELSE amt END",
    "items_json": "CASE WHEN k % 59 = 0 THEN 'corrupt' WHEN k % 61 = 0 THEN '' "
    "WHEN k % 67 = 0 THEN NULL WHEN k % 5 = 0 "
    """THEN '"[{""sku"":""P1"",""qty"":2,""price"":' || amt || '}]"' """
    """ELSE '[{"sku":"P1","qty":2,"price":' || amt || '}]' END""",
}

# The envelope of fixture rows.
RUN_ID = "fixture"
SOURCE_FILE = "orders.csv"
ENGINE = "fixture"
INGESTED_AT = "2026-01-01 00:00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k`` and the columns of the tables that the rules read, under the tables' names and types."""
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("k"),
            "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "c_name", "n_name", "r_name",
        )
    )


def dirtied(joined: DataFrame) -> DataFrame:
    """``joined_orders`` by the rules: the 17 order fields, and ``k``."""
    return joined.select(
        "k",
        F.col("o_custkey").cast("string").alias("c"),
        F.col("o_orderdate").cast("string").alias("d"),
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("amt"),
        "o_orderstatus", "c_name", "n_name", "r_name",
    ).select("k", *[F.expr(rule).alias(field) for field, rule in RULES.items()])


def keyed_dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17 order fields, and ``k``."""
    return dirtied(joined_orders(spark, sf_dir))


def order_count(spark: SparkSession, sf_dir: str) -> int:
    return _table(spark, sf_dir, "orders").count()


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_dirty_orders(spark, sf_dir).drop("k")


def enveloped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as the raw layer would hold them; ``k`` is the row number less one."""
    return pack(
        keyed_dirty_orders(spark, sf_dir),
        RUN_ID,
        ENGINE,
        F.lit(SOURCE_FILE),
        F.col("k") + 1,
        ingested_at=F.lit(INGESTED_AT).cast("timestamp"),
    )


DIRTY_SQL = f"""
SELECT k, {', '.join(f'{rule} AS {field}' for field, rule in RULES.items())}
FROM (
  SELECT o_orderkey AS k, cast(o_custkey AS string) AS c, cast(o_orderdate AS string) AS d,
         cast(cast(o_totalprice AS decimal(15, 2)) AS string) AS amt,
         o_orderstatus, c_name, n_name, r_name
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)
"""
assert tuple(RULES) == S.ORDER_FIELDS
