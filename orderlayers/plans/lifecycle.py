"""From files to layers in one call; looking at layers; starting over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlayers import schema as S
from orderlayers.plans.elt import run_elt
from orderlayers.plans.ingest import ingest_files
from orderlayers.sources.keyed_layers import preview_layer, read_layer, reset_layer
from orderlayers.sources.raw_layer import read_raw

LAYERS = (S.RAW, S.VALIDATED, S.QUARANTINE)


def load_orders(
    spark: SparkSession, path: str, base: str, run_id: str, **ingest_options
) -> tuple[dict, dict | None]:
    """Ingest the files at ``path``, then run ELT; return both reports."""
    ingested = ingest_files(spark, path, base, run_id, **ingest_options)
    return ingested, run_elt(spark, base, run_id)


def reset_layers(spark: SparkSession, base: str) -> None:
    """Empty all three layers; reports stay."""
    for layer in LAYERS:
        reset_layer(spark, base, layer)


def preview_layers(
    spark: SparkSession, base: str, rows: int = 10, repeatable: bool = False
) -> dict[str, DataFrame]:
    """A few rows of each layer, keys hidden."""
    order = dict.fromkeys(LAYERS, None)
    if repeatable:
        order = {S.RAW: "source_row_number", S.VALIDATED: "_id", S.QUARANTINE: "_id"}
    return {
        layer: preview_layer(
            read_raw(spark, base) if layer == S.RAW else read_layer(spark, base, layer),
            rows,
            order[layer],
        )
        for layer in LAYERS
    }
