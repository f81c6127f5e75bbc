"""Time the headline queries and jobs; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_COPIES how many
times the order files are ingested for the larger ELT figure (0 leaves it out).
"""

from __future__ import annotations

import json
import os
import time

from orderlayers.operators import (
    audit_rows,
    classify,
    classify_accepted,
    latest_per_key,
    quarantine_reasons,
    status_counts,
    validate,
)
from orderlayers.plans import ingest_files, run_elt, write_sample
from orderlayers.queries.registry import QUERIES, _order_files
from orderlayers.session import build_session, scratch_path
from orderlayers.sources import read_raw
from orderlayers.streaming import ingest_stream

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "10"))


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    rates: dict[str, float] = {}

    def timed(name, action):
        started = time.monotonic()
        result = action()
        seconds[name] = round(time.monotonic() - started, 3)
        return result

    # The session's first query pays for starting up and is not counted.
    drain(QUERIES["classify_orders"](spark, FOLDER))

    files = _order_files(spark, FOLDER, int(CPUS))
    base = scratch_path(spark, "bench")
    first = timed("ingest", lambda: ingest_files(spark, files, base, "r1"))
    timed("elt_insert", lambda: run_elt(spark, base, "e1"))
    timed("elt_update", lambda: run_elt(spark, base, "e2"))
    raw = read_raw(spark, base)
    timed("classify", lambda: drain(classify(raw)))
    timed("status_counts", lambda: status_counts(classify(raw)).collect())
    timed("quarantine_reasons", lambda: quarantine_reasons(classify(raw)).collect())
    timed("audit_trail", lambda: drain(audit_rows(classify(raw), "source_row_number")))
    timed("validate", lambda: drain(validate(raw)))
    timed("latest_by_key", lambda: drain(latest_per_key(classify_accepted(raw))))
    timed("sample", lambda: write_sample(spark, files, scratch_path(spark, "sample"), 50_000))
    streamed = scratch_path(spark, "bench")
    timed("ingest_stream", lambda: ingest_stream(spark, files, streamed, "s1", max_files=4))
    for name in ("classify_orders", "validation_errors", "upsert_counts", "upsert_validated"):
        timed(f"query_{name}", lambda name=name: drain(QUERIES[name](spark, FOLDER)))

    rows = first["rows_read"]
    for name in ("ingest", "elt_insert", "elt_update", "ingest_stream", "classify", "validate"):
        rates[name] = round(rows / seconds[name], 2)
    if COPIES:
        large = scratch_path(spark, "bench")
        timed(
            "ingest_copies",
            lambda: [ingest_files(spark, files, large, f"r{i}") for i in range(COPIES)],
        )
        timed("elt_copies_insert", lambda: run_elt(spark, large, "e1"))
        timed("elt_copies_update", lambda: run_elt(spark, large, "e2"))
        for name in ("ingest_copies", "elt_copies_insert", "elt_copies_update"):
            rates[name] = round(COPIES * rows / seconds[name], 2)
    spark.stop()
    line = {
        "metric": "total seconds of headline jobs and queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": rates,
        "rows": rows,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
