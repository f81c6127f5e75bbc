"""Files, layers and reports as sources and sinks."""

from orderlayers.sources.inventory import file_inventory
from orderlayers.sources.key_filters import (
    may_be_stored,
    stored_keys_among,
    write_key_filters,
)
from orderlayers.sources.keyed_layers import (
    existing_keys,
    preview_layer,
    read_layer,
    reset_layer,
    upsert,
)
from orderlayers.sources.ledger import merged_runs, new_runs
from orderlayers.sources.order_files import (
    read_orders,
    read_orders_by_header,
    write_orders_csv,
)
from orderlayers.sources.publications import drop_old_versions
from orderlayers.sources.raw_layer import append_raw, raw_path, read_raw
from orderlayers.sources.reports import (
    append_report,
    latest_report,
    read_batch_reports,
    read_reports,
    unify_reports,
)

__all__ = [
    "append_raw", "append_report", "drop_old_versions", "existing_keys", "file_inventory", "latest_report",
    "may_be_stored", "merged_runs", "new_runs", "preview_layer", "raw_path", "read_batch_reports", "read_layer", "read_orders",
    "read_orders_by_header", "read_raw", "read_reports", "reset_layer",
    "stored_keys_among", "unify_reports", "upsert", "write_key_filters", "write_orders_csv",
]
