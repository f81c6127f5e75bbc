"""The ingest envelope around a raw record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators.headers import named


def pack(
    df: DataFrame,
    run_id: str,
    engine_used: str,
    source_file: Column,
    source_row_number: Column,
    fields: tuple[str, ...] = S.ORDER_FIELDS,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Every input field into one struct, beside the run's metadata.

    A column ``extra`` of the input, fields beyond the known ones, is kept as it is.
    """
    extra = F.col(S.EXTRA.name) if S.EXTRA.name in df.columns else F.lit(None)
    return df.select(
        F.lit(run_id).alias("run_id"),
        source_file.alias("source_file"),
        source_row_number.cast("long").alias("source_row_number"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.lit(engine_used).alias("engine_used"),
        F.struct(*[named(field) for field in fields]).alias("raw_record"),
        extra.cast(S.EXTRA.dataType).alias(S.EXTRA.name),
    )


def unpack(df: DataFrame, keep_record: bool = False) -> DataFrame:
    """Envelope fields and the record's fields side by side.

    A frame without ``raw_record`` is taken as flat already. ``keep_record`` leaves out
    the key and keeps the struct, which is the form validation works on.
    """
    if "raw_record" not in df.columns:
        return df
    lead = ["_id"] if "_id" in df.columns and not keep_record else []
    tail = ["raw_record"] if keep_record else []
    return df.select(*lead, *S.ENVELOPE_FIELDS, "raw_record.*", *tail)
