from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlayers import functions as fn


def apply(spark, function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    cleaned = rows.select("i", function(F.col("v")).alias("v")).collect()
    return [row["v"] for row in sorted(cleaned)]


AMOUNTS = {
    "١٢٣٫٥٠": "123.50",
    "1,234.50": "1234.50",
    "١٬٢٣٤": "1234",
    "$12.00": "12.00",
    "غير": "",
    "-5": "-5",
    None: None,
    "": "",
    "1.234,50": "1.23450",
    "100 ر.س": "100.",
    "1e3": "13",
    "12-34": "12-34",
    "۱۲۳": "",
    "10\n": "10",
}

DATES = {
    "+2024-01-01": "2024-01-01 00:00:00",
    "\x012024-01-02": "2024-01-02 00:00:00",
    "2024-01-15": "2024-01-15 00:00:00",
    "2024-1-5": "2024-01-05 00:00:00",
    "2024": "2024-01-01 00:00:00",
    " 2024-01-15 ": "2024-01-15 00:00:00",
    "2024-01-15T10:30:00Z": "2024-01-15 10:30:00",
    "2024-01-15T10:30:00+02:00": "2024-01-15 08:30:00",
    "2024-01-15 10:30:00.75": "2024-01-15 10:30:00",
    "15/01/2024": None,
    "2024/01/15": None,
    "2024-02-30": None,
    "bad": None,
    "": None,
    None: None,
    "10:30:00": None,
}


def test_amounts(spark):
    assert apply(spark, fn.clean_amount, AMOUNTS) == list(AMOUNTS.values())


def test_dates(spark):
    assert apply(spark, fn.clean_date, DATES) == list(DATES.values())


def test_phone_email_and_text(spark):
    phones = {"+20 123\t45 ": "+2012345", "123": "123", " ": "", "1 2": "1 2", None: None}
    assert apply(spark, fn.clean_phone, phones) == list(phones.values())
    emails = {"a@@b..com": "a@b.com", "a@@@b...c.d": "a@b.c.d", "a@b.c": "a@b.c", None: None}
    assert apply(spark, fn.clean_email, emails) == list(emails.values())
    texts = {"  x  ": "x", "\tx": "\tx", " x": " x", "": "", None: None}
    assert apply(spark, fn.clean_text, texts) == list(texts.values())


TEXT = st.text(alphabet="0159.-,@ \t\n\r\x0b\x0c\x1c٠٥٩٫٬ab€ر", max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(TEXT, min_size=50, max_size=200))
def test_repairs_equal_plain_replacement(spark, values):
    """The look-first shortcut never changes the result of the replacement."""
    ascii_digits = str.maketrans("٠١٢٣٤٥٦٧٨٩٫", "0123456789.")
    assert apply(spark, fn.clean_amount, values) == [
        re.sub(r"[^0-9.\-]", "", v.translate(ascii_digits)) for v in values
    ]
    assert apply(spark, fn.clean_phone, values) == [
        re.sub(r"[ \t\n\x0b\f\r]+", "", v) for v in values
    ]
    assert apply(spark, fn.clean_email, values) == [
        re.sub(r"\.+", ".", re.sub(r"@+", "@", v)) for v in values
    ]


@pytest.mark.parametrize(
    ("text", "opens"),
    [
        ("[1]", True), ('{"a":1}', True), ('"[{""a"":1}]"', True), ('  "\t[', True),
        ("corrupt", False), ("", False), ("x[", False), (" [", False),
    ],
)
def test_json_opening(spark, text, opens):
    row = spark.range(1).select(fn.opens_like_json(F.lit(text)).alias("v")).first()
    assert row["v"] is opens


def test_currency_and_items(spark):
    codes = {" usd ": "USD", "ر.س": "SAR", "US$": "USD", "EUR": "EUR", "": None, None: None}
    assert apply(spark, fn.standard_currency, codes) == list(codes.values())
    items = {
        '[{"sku":"P","qty":2,"price":1.50},{"sku":"Q","qty":1,"price":0.25}]': "3.25",
        '"[{""sku"":""P"",""qty"":2,""price"":1.50}]"': "3.00",
        "[]": "0.00",
        "corrupt": None,
        None: None,
    }
    totals = apply(
        spark, lambda c: fn.items_total(c).cast("decimal(20,2)").cast("string"), items
    )
    assert totals == list(items.values())
