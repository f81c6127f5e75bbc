"""Whole jobs: ingest, ELT, sampling, reset."""

from orderlayers.plans.elt import run_elt
from orderlayers.plans.ingest import ingest_files
from orderlayers.plans.lifecycle import load_orders, preview_layers, reset_layers
from orderlayers.plans.sample import sample_rows, write_sample

__all__ = [
    "ingest_files", "load_orders", "preview_layers", "reset_layers", "run_elt",
    "sample_rows", "write_sample",
]
