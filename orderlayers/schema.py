"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


# The order file's columns, in file order.
ORDER_FIELDS = (
    "order_id", "order_date", "status", "customer_id", "customer_name",
    "customer_phone", "customer_email", "city", "district", "delivery_type",
    "delivery_cost", "payment_method", "payment_status", "payment_amount",
    "currency", "total_amount", "items_json",
)

# The columns that cleaning replaces, in output order.
REPAIRED_FIELDS = (
    "total_amount", "customer_phone", "customer_email", "city", "status", "order_date",
)

# The ingest metadata kept beside every raw record.
ENVELOPE_FIELDS = (
    "run_id", "source_file", "source_row_number", "ingested_at", "engine_used",
)

# Record statuses.
VALID = "Valid"
CORRECTED = "Corrected"
QUARANTINED = "Quarantined"
MISSING_ORDER_ID = "Quarantined: MISSING_ORDER_ID"
MISSING_CUSTOMER_ID = "Quarantined: MISSING_CUSTOMER_ID"
CORRUPTED_ITEMS_JSON = "Quarantined: CORRUPTED_ITEMS_JSON"
UNKNOWN_PRICE = "Quarantined: UNKNOWN_PRICE"
ACCEPTED_STATUSES = (VALID, CORRECTED)
QUARANTINE_STATUSES = (
    MISSING_ORDER_ID, MISSING_CUSTOMER_ID, CORRUPTED_ITEMS_JSON, UNKNOWN_PRICE,
)

# Layer names.
RAW = "orders_raw"
VALIDATED = "orders_validated"
QUARANTINE = "orders_quarantine"

RAW_SCHEMA = T.StructType(_strings(ORDER_FIELDS))

_ENVELOPE = [
    T.StructField("run_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_row_number", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("engine_used", T.StringType()),
]

# Fields that a header names beyond the known ones, by name; NULL where there are none.
EXTRA = T.StructField("extra", T.MapType(T.StringType(), T.StringType()))

RAW_ENVELOPE = T.StructType([*_ENVELOPE, T.StructField("raw_record", RAW_SCHEMA), EXTRA])

CORRECTION = T.StructType(
    _strings(["field", "original_value", "corrected_value", "rule_code"])
)

CORRECTIONS = T.ArrayType(CORRECTION)

LAYER_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        *_ENVELOPE,
        *_strings(f for f in ORDER_FIELDS if f not in REPAIRED_FIELDS),
        *_strings(REPAIRED_FIELDS),
        T.StructField("corrections", CORRECTIONS),
        T.StructField("record_status", T.StringType()),
    ]
)

# One shape for every report; fields a stage does not produce stay NULL.
RUN_REPORT = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("source_file_count", T.LongType()),
        T.StructField("file_size_mb", T.DoubleType()),
        T.StructField("engine_used", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("raw_loaded", T.LongType()),
        T.StructField("valid_count", T.LongType()),
        T.StructField("corrected_count", T.LongType()),
        T.StructField("quarantine_count", T.LongType()),
        T.StructField("error_case_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("null_date_count", T.LongType()),
        T.StructField("inserted_count", T.LongType()),
        T.StructField("updated_count", T.LongType()),
        T.StructField("unchanged_count", T.LongType()),
        T.StructField("inserted_keys", T.LongType()),
        T.StructField("updated_keys", T.LongType()),
        T.StructField("quarantine_keys", T.LongType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("throughput", T.DoubleType()),
        T.StructField("partitions", T.LongType()),
        T.StructField("input_partitions", T.LongType()),
        T.StructField("batch_size", T.LongType()),
        T.StructField("batches", T.LongType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)

# Names that older reports use for the same facts.
LEGACY_REPORT_FIELDS = T.StructType(
    [
        T.StructField("engine", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("elapsed_time", T.DoubleType()),
    ]
)

BATCH_REPORT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("rows_per_second", T.DoubleType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)

PUBLICATION = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        # Rows of the layer; the versions that hold its buckets, and for each bucket the place
        # of its own among them, both comma-joined.
        T.StructField("rows", T.LongType()),
        T.StructField("holders", T.StringType()),
        T.StructField("held_by", T.StringType()),
    ]
)
