"""Column-name repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"


def named(column: str) -> Column:
    """The column with exactly this name, whatever characters are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def repair_headers(df: DataFrame) -> DataFrame:
    """Drop byte-order marks and outer whitespace from names, merging twins.

    Where several columns end up with one name, the one that had the clean name wins
    wherever it is not NULL, then the damaged ones in frame order.
    """
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(name.replace(BYTE_ORDER_MARK, "").strip(), []).append(name)
    if all(found == [clean] for clean, found in sources.items()):
        return df
    place = {}
    for clean, found in sources.items():
        found.sort(key=lambda name: name != clean)
        place[clean] = df.columns.index(found[0])
    return df.select(
        *[
            F.coalesce(*[named(name) for name in sources[clean]]).alias(clean)
            for clean in sorted(place, key=place.get)
        ]
    )
