"""Layer keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlayers.functions.predicates import is_blank

# Prefix of made-up keys and the stand-in for a missing part.
FALLBACK_PREFIX = "q_"
UNKNOWN = "unknown"


def validated_key() -> Column:
    """The order id as it stands: blankness is judged trimmed, the key is not."""
    return F.col("order_id")


def quarantine_key() -> Column:
    """The order id, or a hash of customer and cleaned date where there is none.

    Only NULL parts become ``unknown``; a blank customer stays blank.
    """
    parts = F.concat_ws(
        "_",
        F.coalesce(F.col("customer_id"), F.lit(UNKNOWN)),
        F.coalesce(F.col("order_date"), F.lit(UNKNOWN)),
    )
    made_up = F.concat(F.lit(FALLBACK_PREFIX), F.md5(parts))
    return F.when(is_blank(F.col("order_id")), made_up).otherwise(F.col("order_id"))
