"""Currency codes by a table of aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.functions.money import standard_currency

#: Aliases up to this number are broadcast; longer tables are joined like any other.
BROADCAST_ALIASES = 100_000


def with_standard_currency(
    df: DataFrame, aliases: DataFrame, currency: str = "currency", output: str = "standard_currency"
) -> DataFrame:
    """Add the standard code of ``currency`` by a table of aliases (alias, code).

    Names are compared in upper case, without outer spaces. A name that is no alias goes by the
    built-in ones and otherwise stays, in upper case; a blank one is NULL. Of several codes for one
    alias the smallest counts; aliases or codes that are NULL or blank are passed over.
    """
    name = F.upper(F.trim(F.col("alias")))
    known = (
        aliases.select(name.alias("__alias"), F.upper(F.trim(F.col("code"))).alias("__code"))
        .filter("__alias <> '' AND __code <> ''")
        .groupBy("__alias")
        .agg(F.min("__code").alias("__code"))
    )
    if aliases.limit(BROADCAST_ALIASES + 1).count() <= BROADCAST_ALIASES:
        known = F.broadcast(known)
    own = F.upper(F.trim(F.col(currency)))
    joined = df.join(known, own == F.col("__alias"), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.coalesce("__code", standard_currency(F.col(currency))).alias(output),
    )
