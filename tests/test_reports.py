from __future__ import annotations

import json

from pyspark.sql import functions as F

from orderlayers.operators import rates
from orderlayers.sources import append_report, latest_report, read_reports
from orderlayers.sources.reports import read_report_file


def test_append_then_latest(spark, base):
    assert latest_report(read_reports(spark, base)).isEmpty()
    for run, rows in (("b", 1), ("a", 2)):
        append_report(
            spark, base, {"run_id": run, "rows_read": rows, "error_case_counts": {"x": rows}}
        )
    latest = latest_report(read_reports(spark, base)).first()
    assert latest["run_id"] == "a" and latest["rows_read"] == 2
    assert latest["error_case_counts"] == {"x": 2} and latest["inserted_count"] is None


def test_list_single_and_old_names(spark, tmp_path):
    old = {"run_id": "r1", "engine": "e", "source_file": "f", "raw_loaded": 5, "elapsed_time": 1.5}
    new = {"run_id": "r2", "engine_used": "n", "file_name": "g", "rows_read": 7, "raw_loaded": 9}
    path = tmp_path / "reports.json"
    path.write_text(json.dumps([old, new], indent=4))
    rows = read_report_file(spark, str(path))
    first, second = rows.orderBy("run_id").collect()
    assert (first["engine_used"], first["file_name"], first["rows_read"]) == ("e", "f", 5)
    assert first["elapsed_seconds"] == 1.5 and first["valid_count"] == 0
    assert (second["engine_used"], second["file_name"], second["rows_read"]) == ("n", "g", 7)
    assert latest_report(rows).first()["run_id"] == "r2"
    path.write_text(json.dumps(old, indent=4))
    assert [r["run_id"] for r in read_report_file(spark, str(path)).collect()] == ["r1"]


def test_defaults(spark, tmp_path):
    (tmp_path / "r.json").write_text("{}")
    row = read_report_file(spark, str(tmp_path / "r.json")).first()
    assert (row["engine_used"], row["run_id"], row["file_name"]) == ("N/A", "N/A", "N/A")
    assert (row["rows_read"], row["throughput"]) == (0, 0.0)


def test_finished_later_beats_larger_run_id(spark, base):
    append_report(spark, base, {"run_id": "z", "finished_at": F.lit("2024-01-01")})
    append_report(spark, base, {"run_id": "a", "finished_at": F.lit("2024-01-02")})
    assert latest_report(read_reports(spark, base)).first()["run_id"] == "a"


def test_rates():
    assert rates(10, 0) == (0, 0.0)
    assert rates(10, 3) == (3, 3.33)
