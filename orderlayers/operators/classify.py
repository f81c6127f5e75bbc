"""Record status and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlayers import functions as fn
from orderlayers import schema as S
from orderlayers.operators.envelope import unpack
from orderlayers.operators.headers import repair_headers
from orderlayers.operators.repair import repair_fields


def _quarantine_reason(amount: Column) -> Column:
    """The first quarantine rule that matches, given the cleaned amount; NULL if none."""
    items = F.col("items_json")
    return (
        F.when(fn.is_blank(F.col("order_id")), S.MISSING_ORDER_ID)
        .when(fn.is_blank(F.col("customer_id")), S.MISSING_CUSTOMER_ID)
        .when(items.isNotNull() & ~fn.opens_like_json(items), S.CORRUPTED_ITEMS_JSON)
        .when(amount == "", S.UNKNOWN_PRICE)
    )


def with_status(df: DataFrame) -> DataFrame:
    """Add ``record_status`` to a repaired frame; the first matching rule decides."""
    kept = F.when(F.size("corrections") > 0, S.CORRECTED).otherwise(S.VALID)
    status = F.coalesce(_quarantine_reason(F.col("total_amount")), kept)
    return df.select("*", status.alias("record_status"))


def _records(df: DataFrame) -> DataFrame:
    return df.transform(unpack).transform(repair_headers)


def classify(df: DataFrame) -> DataFrame:
    """Raw envelope or flat order rows in; repaired, audited, classified rows out."""
    return df.transform(_records).transform(repair_fields).transform(with_status)


def accepted(df: DataFrame) -> DataFrame:
    """Valid and corrected rows of a classified frame under their business key."""
    rows = df.filter(fn.is_accepted(F.col("record_status")))
    return _keyed(rows, fn.validated_key())


def quarantined(df: DataFrame) -> DataFrame:
    """Quarantined rows of a classified frame under their order id or a made-up key."""
    rows = df.filter(fn.is_quarantined(F.col("record_status")))
    return _keyed(rows, fn.quarantine_key())


def routed(df: DataFrame) -> DataFrame:
    """All rows of a classified frame under their keys, with the ``layer`` each one goes to."""
    held = fn.is_quarantined(F.col("record_status"))
    rows = _keyed(df, F.when(held, fn.quarantine_key()).otherwise(fn.validated_key()))
    return rows.withColumn("layer", F.when(held, S.QUARANTINE).otherwise(S.VALIDATED))


def classify_accepted(df: DataFrame) -> DataFrame:
    """``accepted(classify(df))`` that turns the other rows away before repairing any.

    A filter on ``record_status`` would be pushed below the projections with the whole
    audit trail inlined, every replacement several times over. The quarantine rules
    alone decide, and of the cleaned fields they need the amount only.
    """
    rows = _records(df).filter(_raw_reason().isNull())
    return _keyed(rows.transform(repair_fields).transform(with_status), fn.validated_key())


def classify_quarantined(df: DataFrame) -> DataFrame:
    """``quarantined(classify(df))`` that repairs the quarantined rows only."""
    rows = _records(df).filter(_raw_reason().isNotNull())
    return _keyed(rows.transform(repair_fields).transform(with_status), fn.quarantine_key())


def _raw_reason() -> Column:
    return _quarantine_reason(fn.clean_amount(F.col("total_amount")))


def _keyed(df: DataFrame, key: Column) -> DataFrame:
    return df.select(key.alias("_id"), *[c for c in df.columns if c != "_id"])
