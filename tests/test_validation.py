from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlayers.operators import validate
from orderlayers.operators import validation as V
from orderlayers.queries.dirty_orders import dirty_orders, enveloped_orders


@pytest.mark.parametrize(
    ("change", "errors"),
    [
        ({}, []),
        ({"order_id": " "}, [V.ORDER_ID_EMPTY]),
        ({"order_date": None}, [V.ORDER_DATE_EMPTY]),
        ({"status": " مؤكد "}, []),
        ({"status": "done"}, [V.STATUS_UNKNOWN]),
        ({"status": None}, []),
        ({"customer_id": ""}, [V.CUSTOMER_ID_EMPTY]),
        ({"customer_phone": " +1234567 "}, []),
        ({"customer_phone": "123456"}, [V.PHONE_FORMAT]),
        ({"customer_phone": "1" * 16}, [V.PHONE_FORMAT]),
        ({"customer_phone": None}, []),
        ({"customer_email": "a.b-c@d.e.f"}, []),
        ({"customer_email": "a@@b.c"}, [V.EMAIL_FORMAT]),
        ({"delivery_cost": "-0.01"}, [V.NEGATIVE_DELIVERY]),
        ({"delivery_cost": "n/a"}, []),
        ({"total_amount": "0"}, [V.PAYMENT_NOT_POSITIVE]),
        ({"total_amount": "SAR 5", "payment_amount": "-1"}, []),
        (
            {"order_id": None, "status": "x", "total_amount": "-1"},
            [V.ORDER_ID_EMPTY, V.STATUS_UNKNOWN, V.PAYMENT_NOT_POSITIVE],
        ),
    ],
    ids=str,
)
def test_rules(orders, change, errors):
    row = validate(orders(change)).first()
    assert row["detected_errors"] == errors
    assert row["is_clean_record"] is (not errors)


def test_missing_columns(orders):
    bad = orders({"delivery_cost": "-1", "total_amount": "-1", "payment_amount": "0"})
    rows = validate(bad.drop("delivery_cost", "total_amount"))
    assert rows.first()["detected_errors"] == [V.PAYMENT_NOT_POSITIVE]
    rows = validate(bad.drop("delivery_cost", "total_amount", "payment_amount"))
    assert rows.first()["detected_errors"] == []
    nothing = validate(bad.select("city")).first()
    assert nothing["detected_errors"] == [] and nothing["is_clean_record"] is True


def test_envelope_keeps_record(spark, small):
    rows = validate(enveloped_orders(spark, small))
    assert "raw_record" in rows.columns and "_id" not in rows.columns
    assert dict(rows.dtypes)["detected_errors"] == "array<string>"


# Rows with each error, in rule order, then rows with none.
GOLDEN = {
    "sf0.001": [32, 26, 41, 44, 150, 121, 32, 26, 1073],
    "sf0.01": [310, 253, 406, 424, 1491, 1211, 320, 262, 10872],
}


@pytest.mark.parametrize("size", GOLDEN)
def test_golden_counts(spark, size):
    rows = validate(dirty_orders(spark, f"/root/testdata/{size}"))
    messages = [
        V.ORDER_ID_EMPTY, V.ORDER_DATE_EMPTY, V.STATUS_UNKNOWN, V.CUSTOMER_ID_EMPTY,
        V.PHONE_FORMAT, V.EMAIL_FORMAT, V.NEGATIVE_DELIVERY, V.PAYMENT_NOT_POSITIVE,
    ]
    counted = rows.agg(
        *[F.count_if(F.array_contains("detected_errors", m)).alias(m) for m in messages],
        F.count_if("is_clean_record").alias("clean"),
    )
    assert list(counted.first()) == GOLDEN[size]
