from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators import (
    accepted,
    classify,
    classify_accepted,
    classify_quarantined,
    quarantined,
)
from orderlayers.queries.dirty_orders import dirty_orders, enveloped_orders

CASES = [
    ({}, S.VALID),
    ({"order_id": None}, S.MISSING_ORDER_ID),
    ({"order_id": "  "}, S.MISSING_ORDER_ID),
    ({"order_id": "\t"}, S.VALID),
    ({"customer_id": ""}, S.MISSING_CUSTOMER_ID),
    ({"order_id": None, "customer_id": None}, S.MISSING_ORDER_ID),
    ({"items_json": "corrupt"}, S.CORRUPTED_ITEMS_JSON),
    ({"items_json": ""}, S.CORRUPTED_ITEMS_JSON),
    ({"items_json": None}, S.VALID),
    ({"total_amount": "غير معروف"}, S.UNKNOWN_PRICE),
    ({"total_amount": ""}, S.UNKNOWN_PRICE),
    ({"total_amount": None}, S.VALID),
    ({"total_amount": "-5"}, S.VALID),
    ({"items_json": "corrupt", "total_amount": ""}, S.CORRUPTED_ITEMS_JSON),
    ({"total_amount": "١٢"}, S.CORRECTED),
    ({"city": " Cairo "}, S.CORRECTED),
    ({"status": " مؤكد "}, S.VALID),
    ({"order_date": "bad"}, S.VALID),
    ({"customer_phone": "bad", "customer_email": "bad"}, S.VALID),
]


@pytest.mark.parametrize("change", [c for c, _ in CASES], ids=str)
def test_status(orders, change):
    expected = next(status for c, status in CASES if c == change)
    assert classify(orders(change)).first()["record_status"] == expected


def test_audit_trail_keeps_order_and_originals(orders):
    change = {
        "total_amount": "$5", "customer_phone": "1 2", "customer_email": "a@@b.c", "city": " x",
        "status": " s ", "order_date": "2024",
    }
    row = classify(orders(change)).first()
    assert [tuple(c) for c in row["corrections"]] == [
        ("total_amount", "$5", "5", "FIX_ARABIC_AND_SYMBOLS"),
        ("customer_phone", "1 2", "12", "TRIM_PHONE_SPACES"),
        ("customer_email", "a@@b.c", "a@b.c", "FIX_EMAIL_TYPOS"),
        ("city", " x", "x", "TRIM_SPACES"),
    ]
    assert row["status"] == "s" and row["order_date"] == "2024-01-01 00:00:00"


def test_null_fields_make_no_correction(orders):
    row = classify(orders(dict.fromkeys(S.REPAIRED_FIELDS))).first()
    assert row["corrections"] == [] and row["record_status"] == S.VALID


def test_output_columns(spark, small):
    rows = classify(enveloped_orders(spark, small))
    untouched = [f for f in S.ORDER_FIELDS if f not in S.REPAIRED_FIELDS]
    assert rows.columns == [
        *S.ENVELOPE_FIELDS, *untouched, *S.REPAIRED_FIELDS, "corrections", "record_status",
    ]
    assert rows.schema["corrections"].dataType == S.CORRECTIONS
    assert accepted(rows).columns == S.LAYER_SCHEMA.names


def test_missing_cleaned_column_raises(spark, small):
    with pytest.raises(Exception, match="total_amount"):
        classify(dirty_orders(spark, small).drop("total_amount"))


# Rows, corrections of amount, phone, email, city, and NULL dates.
GOLDEN = {
    "sf0.001": {
        "Corrected": (749, 566, 104, 124, 123, 94),
        "Valid": (602, 0, 0, 0, 0, 74),
        "Quarantined: CORRUPTED_ITEMS_JSON": (47, 19, 2, 2, 5, 7),
        "Quarantined: MISSING_CUSTOMER_ID": (43, 19, 3, 3, 4, 4),
        "Quarantined: MISSING_ORDER_ID": (32, 12, 2, 4, 3, 2),
        "Quarantined: UNKNOWN_PRICE": (27, 14, 2, 0, 2, 3),
    },
    "sf0.01": {
        "Corrected": (7480, 5640, 1018, 1208, 1228, 914),
        "Valid": (6053, 0, 0, 0, 0, 743),
        "Quarantined: CORRUPTED_ITEMS_JSON": (473, 199, 33, 41, 44, 57),
        "Quarantined: MISSING_CUSTOMER_ID": (415, 175, 30, 36, 38, 49),
        "Quarantined: MISSING_ORDER_ID": (310, 130, 23, 28, 28, 37),
        "Quarantined: UNKNOWN_PRICE": (269, 137, 21, 24, 26, 33),
    },
}


@pytest.mark.parametrize("size", GOLDEN)
def test_golden_counts(spark, size):
    rows = classify(dirty_orders(spark, f"/root/testdata/{size}"))
    codes = F.col("corrections.rule_code")
    counted = rows.groupBy("record_status").agg(
        F.count(F.lit(1)),
        *[
            F.count_if(F.array_contains(codes, code))
            for code in (
                "FIX_ARABIC_AND_SYMBOLS", "TRIM_PHONE_SPACES", "FIX_EMAIL_TYPOS", "TRIM_SPACES",
            )
        ],
        F.count_if(F.col("order_date").isNull()),
    )
    assert {row[0]: tuple(row[1:]) for row in counted.collect()} == GOLDEN[size]


def test_early_routing_equals_filtering_afterwards(spark, small):
    raw = enveloped_orders(spark, small)
    rows = classify(raw)
    for early, late in (
        (classify_accepted(raw), accepted(rows)),
        (classify_quarantined(raw), quarantined(rows)),
    ):
        assert early.columns == late.columns
        assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty()


def test_quarantine_keys(orders):
    import hashlib

    def made_up(text):
        return "q_" + hashlib.md5(text.encode()).hexdigest()

    def key(change):
        return classify_quarantined(orders(change)).first()["_id"]

    day = "2024-01-15 10:00:00"
    assert key({"customer_id": None}) == "ORD-1"
    assert key({"order_id": " ", "order_date": "2024-01-15"}) == made_up("C1_2024-01-15 00:00:00")
    assert key({"order_id": None, "customer_id": None, "order_date": "x"}) == made_up(
        "unknown_unknown"
    )
    assert key({"order_id": None, "customer_id": "", "order_date": "x"}) == made_up("_unknown")
    assert key({"order_id": None, "customer_id": ""}) == made_up(f"_{day}")
