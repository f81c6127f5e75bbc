"""Currency names and item totals; the semantics of both are this package's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Other spellings of the currency codes.
CURRENCY_ALIASES = {
    "$": "USD",
    "US$": "USD",
    "SR": "SAR",
    "ر.س": "SAR",
    "YR": "YER",
    "ر.ي": "YER",
}

ITEMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("sku", T.StringType()),
            T.StructField("qty", T.DecimalType(18, 3)),
            T.StructField("price", T.DecimalType(18, 2)),
        ]
    )
)


def standard_currency(currency: Column) -> Column:
    """Upper-case code without outer spaces, aliases resolved; blank is NULL."""
    code = F.upper(F.trim(currency))
    known = F.create_map(*[F.lit(x) for pair in CURRENCY_ALIASES.items() for x in pair])
    return F.when(code != "", F.coalesce(F.try_element_at(known, code), code))


def items_total(items_json: Column) -> Column:
    """Sum of quantity times price; NULL where the text is no list of items.

    Text still wrapped in CSV quoting is unwrapped first.
    """
    wrapped = items_json.startswith('"')
    inner = F.replace(
        F.regexp_replace(items_json, r'^"|"$', ""), F.lit('""'), F.lit('"')
    )
    items = F.from_json(F.when(wrapped, inner).otherwise(items_json), ITEMS)
    return F.aggregate(
        items,
        F.lit(0).cast("decimal(38,5)"),
        lambda total, item: (total + item["qty"] * item["price"]).cast("decimal(38,5)"),
    )
