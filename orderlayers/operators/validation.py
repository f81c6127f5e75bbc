"""Eight validation rules over uncleaned values."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlayers.functions import is_blank
from orderlayers.operators.envelope import unpack
from orderlayers.operators.headers import repair_headers

# Statuses, patterns and messages.
KNOWN_STATUSES = ("مؤكد", "قيد الانتظار", "مرتجع", "قيد الشحن", "تم التسليم")
PHONE = r"^\+?[0-9]{7,15}$"
EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"
ORDER_ID_EMPTY = "Order ID is Empty"
ORDER_DATE_EMPTY = "Order Date is Empty"
STATUS_UNKNOWN = "Unrecognized Status"
CUSTOMER_ID_EMPTY = "Customer ID is Empty"
PHONE_FORMAT = "Phone Format Error"
EMAIL_FORMAT = "Email Format Error"
NEGATIVE_DELIVERY = "Delivery Cost Cannot Be Negative"
PAYMENT_NOT_POSITIVE = "Payment Must Be Greater Than Zero"


def _violations(columns: Collection[str]) -> list[tuple[str, Column]]:
    """Message and condition of each rule whose column the frame has, in rule order."""
    amount = next((c for c in ("total_amount", "payment_amount") if c in columns), None)
    rules = [
        ("order_id", ORDER_ID_EMPTY, is_blank),
        ("order_date", ORDER_DATE_EMPTY, is_blank),
        ("status", STATUS_UNKNOWN, lambda c: ~F.trim(c).isin(*KNOWN_STATUSES)),
        ("customer_id", CUSTOMER_ID_EMPTY, is_blank),
        ("customer_phone", PHONE_FORMAT, lambda c: ~F.trim(c).rlike(PHONE)),
        ("customer_email", EMAIL_FORMAT, lambda c: ~F.trim(c).rlike(EMAIL)),
        ("delivery_cost", NEGATIVE_DELIVERY, lambda c: c.try_cast("double") < 0),
        (amount, PAYMENT_NOT_POSITIVE, lambda c: c.try_cast("double") <= 0),
    ]
    return [(message, test(F.col(name))) for name, message, test in rules if name in columns]


def validate(df: DataFrame) -> DataFrame:
    """Add ``detected_errors`` and ``is_clean_record``.

    A rule on a missing column finds nothing, a condition that comes out NULL finds
    nothing, and the amount rule falls back to ``payment_amount``.
    """
    rows = df.transform(unpack, keep_record=True).transform(repair_headers)
    none = F.array().cast("array<string>")
    errors = F.concat(
        none,
        *[
            F.when(condition, F.array(F.lit(message))).otherwise(none)
            for message, condition in _violations(rows.columns)
        ],
    )
    return rows.select("*", errors.alias("detected_errors")).select(
        "*", (F.size("detected_errors") == 0).alias("is_clean_record")
    )


def error_rows(df: DataFrame, *keys: str) -> DataFrame:
    """One row per detected error, beside the given columns."""
    return df.select(*keys, F.explode("detected_errors").alias("error"))
