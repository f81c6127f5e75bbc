from __future__ import annotations

from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators import pack, repair_headers, unpack

BOM = "\ufeff"


def test_clean_twin_wins_where_not_null(spark):
    rows = spark.createDataFrame(
        [("d1", "c1", 1), ("d2", None, 2), (None, "c3", 3), (None, None, 4)],
        f"`{BOM}order_id` string, order_id string, ` n ` int",
    )
    repaired = repair_headers(rows)
    assert repaired.columns == ["order_id", "n"]
    assert [tuple(r) for r in repaired.orderBy("n").collect()] == [
        ("c1", 1), ("d2", 2), ("c3", 3), (None, 4),
    ]


def test_damaged_twins_without_clean_one(spark):
    rows = spark.createDataFrame(
        [(1, None, "b"), (2, "a", "b")], f"k int, ` x` string, `{BOM}x ` string"
    )
    repaired = repair_headers(rows)
    assert repaired.columns == ["k", "x"]
    assert [r["x"] for r in repaired.orderBy("k").collect()] == ["b", "a"]


def test_inner_marks_and_odd_names(spark):
    rows = spark.createDataFrame([(1, 2)], f"`a{BOM}b` int, ` c.d ` int")
    assert repair_headers(rows).columns == ["ab", "c.d"]


def test_clean_frame_is_untouched(orders):
    rows = orders({})
    assert repair_headers(rows) is rows


def test_pack_then_unpack(orders):
    rows = orders({}, {"order_id": None})
    packed = pack(rows, "r", "e", F.lit("f.csv"), F.lit(7))
    assert packed.columns == S.RAW_ENVELOPE.names
    assert [f.dataType for f in packed.schema] == [f.dataType for f in S.RAW_ENVELOPE]
    flat = unpack(packed)
    assert flat.columns == [*S.ENVELOPE_FIELDS, *S.ORDER_FIELDS]
    assert flat.select(*S.ORDER_FIELDS).exceptAll(rows).isEmpty()
    keyed = packed.withColumn("_id", F.lit("x"))
    assert unpack(keyed).columns[0] == "_id"
    assert unpack(keyed, keep_record=True).columns == [*flat.columns, "raw_record"]
    assert unpack(rows) is rows
