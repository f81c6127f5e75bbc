"""Newest row per key, and merging those rows into keyed contents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlayers import schema as S

# What "newest" means, most significant first.
RECENCY = ("ingested_at", "source_file", "source_row_number")

MERGE_FLAGS = ("__copies", "__existed", "__arrived", "__same")


def latest_per_key(
    df: DataFrame,
    tallies: Mapping[str, Column] | None = None,
    key: str = "_id",
    recency: tuple[str, ...] = RECENCY,
) -> DataFrame:
    """The newest row of each key, with ``__copies`` and any further row tallies.

    A ``max`` over one struct is combined before the shuffle, so a key that holds a large
    share of all rows sends one row per task, where a window would pull the whole group
    into one task. The remaining columns end the struct and settle ties the same way
    every time. Tallies are conditions; each becomes a count of the rows meeting it, so
    counts per row survive the reduction to one row per key without another pass.
    """
    rest = [c for c in df.columns if c != key and c not in recency]
    newest = F.max(F.struct(*recency, *rest)).alias("__newest")
    counts = [F.count_if(test).alias(name) for name, test in (tallies or {}).items()]
    return (
        df.groupBy(key)
        .agg(newest, F.count(F.lit(1)).alias("__copies"), *counts)
        .select(key, "__newest.*", "__copies", *(tallies or {}))
        .select(*df.columns, "__copies", *(tallies or {}))
    )


def merge_latest(
    existing: DataFrame,
    latest: DataFrame,
    tallies: tuple[str, ...] = (),
    key: str = "_id",
    business: tuple[str, ...] = S.ORDER_FIELDS,
    keep_newer: bool = False,
    recency: tuple[str, ...] = RECENCY,
) -> DataFrame:
    """Contents after replacing existing rows by ``latest`` ones, key by key.

    With ``keep_newer`` an existing row stays where it is the newer one, by the order of
    ``latest_per_key``, so that runs may be merged in any order, or again. Such a key has
    arrived and stays the same.

    One full outer join gives the new contents and, as flag columns, what happened to
    each key, so counting needs no join of its own. Both sides hold a key once, so no
    task of the join is larger than its share of keys.
    """
    rest = [c for c in existing.columns if c != key and c not in business]
    old = existing.select(
        key, F.struct(*business).alias("__old"), F.struct(*rest).alias("__old_rest")
    )
    new = latest.select(
        key,
        F.struct(*business).alias("__new"),
        F.struct(*rest).alias("__new_rest"),
        "__copies",
        *tallies,
    )
    arrived = F.col("__new").isNotNull()
    existed = F.col("__old").isNotNull()
    stays = F.lit(False)
    if keep_newer:
        order = [*recency, *[c for c in existing.columns if c != key and c not in recency]]

        def place(side: str) -> Column:
            return F.struct(*[F.col(side if c in business else f"{side}_rest")[c] for c in order])

        stays = existed & arrived & (place("__old") > place("__new"))
    flags = {
        "__existed": existed,
        "__arrived": arrived,
        "__same": stays | (arrived & F.col("__new").eqNullSafe(F.col("__old"))),
    }
    return (
        old.join(new, key, "full_outer")
        .select(
            key,
            F.when(~stays & arrived, F.col("__new")).otherwise(F.col("__old")).alias("__row"),
            F.when(~stays & arrived, F.col("__new_rest")).otherwise(F.col("__old_rest")).alias("__rest"),
            "__copies",
            *[flag.alias(name) for name, flag in flags.items()],
            *tallies,
        )
        .select(key, "__row.*", "__rest.*", "__copies", *flags, *tallies)
        .select(*existing.columns, "__copies", *flags, *tallies)
    )


def merge_counts(tallies: tuple[str, ...] = ()) -> list[Column]:
    """Aggregates over a merged frame: rows and keys inserted, updated, unchanged."""
    inserted = F.col("__arrived") & ~F.col("__existed")
    updated = F.col("__arrived") & F.col("__existed")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("__copies"))), F.lit(0))

    return [
        rows(inserted).alias("inserted_count"),
        rows(updated).alias("updated_count"),
        F.count_if(inserted).alias("inserted_keys"),
        F.count_if(updated).alias("updated_keys"),
        F.count_if(F.col("__same")).alias("unchanged_count"),
        F.count_if(F.col("__arrived")).alias("incoming_keys"),
        F.count(F.lit(1)).alias("layer_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in tallies],
    ]


def upsert_counts(existing_keys: DataFrame, incoming: DataFrame, key: str = "_id") -> DataFrame:
    """Inserted and updated counts by row and by key, against keys alone.

    Incoming rows shrink to one per key first, so a hot key joins once.
    """
    per_key = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("__copies"))
    existed = existing_keys.select(F.col(key), F.lit(True).alias("__existed"))
    joined = per_key.join(existed, key, "left")
    fresh = F.col("__existed").isNull()
    copies = F.col("__copies")
    return joined.agg(
        F.coalesce(F.sum(F.when(fresh, copies)), F.lit(0)).alias("inserted_count"),
        F.coalesce(F.sum(F.when(~fresh, copies)), F.lit(0)).alias("updated_count"),
        F.count_if(fresh).alias("inserted_keys"),
        F.count_if(~fresh).alias("updated_keys"),
    )
