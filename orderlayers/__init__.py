"""Order records into raw, validated and quarantine layers, on Spark."""

from orderlayers.operators import classify, validate
from orderlayers.plans import (
    ingest_files,
    load_orders,
    preview_layers,
    reset_layers,
    run_elt,
    write_sample,
)
from orderlayers.session import build_session
from orderlayers.sources import file_inventory, read_layer, read_raw, read_reports
from orderlayers.streaming import ingest_stream

__all__ = [
    "build_session", "classify", "file_inventory", "ingest_files", "ingest_stream",
    "load_orders", "preview_layers", "read_layer", "read_raw", "read_reports",
    "reset_layers", "run_elt", "validate", "write_sample",
]
