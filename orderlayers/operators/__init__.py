"""DataFrame operators, each usable with ``df.transform``."""

from orderlayers.operators.classify import (
    accepted,
    classify,
    classify_accepted,
    classify_quarantined,
    quarantined,
    routed,
    with_status,
)
from orderlayers.operators.counts import (
    quarantine_reasons,
    rates,
    source_summary,
    status_counts,
)
from orderlayers.operators.currency import with_standard_currency
from orderlayers.operators.envelope import pack, unpack
from orderlayers.operators.headers import repair_headers
from orderlayers.operators.merge import (
    latest_per_key,
    merge_counts,
    merge_latest,
    upsert_counts,
)
from orderlayers.operators.numbering import number_rows, with_positions
from orderlayers.operators.repair import audit_rows, repair_fields
from orderlayers.operators.validation import error_rows, validate

__all__ = [
    "accepted", "audit_rows", "classify", "classify_accepted", "classify_quarantined",
    "error_rows", "latest_per_key", "merge_counts",
    "merge_latest", "number_rows", "pack", "quarantine_reasons", "quarantined", "rates",
    "repair_fields", "repair_headers", "routed", "source_summary", "status_counts", "unpack",
    "upsert_counts", "validate", "with_positions", "with_standard_currency", "with_status",
]
