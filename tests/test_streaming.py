from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from orderlayers.operators import unpack
from orderlayers.plans import ingest_files, run_elt
from orderlayers.queries.registry import _order_files
from orderlayers.sources import read_batch_reports, read_raw, read_reports
from orderlayers.streaming import ingest, ingest_stream


@pytest.fixture(scope="module")
def files(spark):
    return _order_files(spark, "/root/testdata/sf0.001", files=5).removeprefix("file:")


def rows(spark, base):
    return unpack(read_raw(spark, base)).drop("run_id", "ingested_at", "engine_used")


def same(left, right) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_equals_batch(spark, base, files):
    report = ingest_stream(spark, files, f"{base}/s", "r1", max_files=2)
    assert report["rows_read"] == report["raw_loaded"] == 1500 and report["batches"] == 3
    ingest_files(spark, files, f"{base}/b", "r1")
    assert same(rows(spark, f"{base}/s"), rows(spark, f"{base}/b"))
    batches = read_batch_reports(spark, f"{base}/s", "r1").orderBy("batch_id").collect()
    assert [b["batch_id"] for b in batches] == [0, 1, 2]
    assert all(b["rows"] > 0 and b["seconds"] > 0 and b["rows_per_second"] > 0 for b in batches)
    assert read_reports(spark, f"{base}/s").first()["batch_size"] == 2
    assert run_elt(spark, f"{base}/s", "e1")["rows_read"] == 1500


def test_later_files_only_are_taken(spark, base, files, tmp_path):
    arriving = tmp_path / "in"
    arriving.mkdir()
    parts = sorted(Path(files).glob("*.csv"))
    shutil.copy(parts[0], arriving)
    first = ingest_stream(spark, str(arriving), base, "r1", max_files=1)
    for part in parts[1:]:
        shutil.copy(part, arriving)
    both = ingest_stream(spark, str(arriving), base, "r1", max_bytes=2**30)
    again = ingest_stream(spark, str(arriving), base, "r1", max_files=1)
    assert 0 < first["rows_read"] < both["rows_read"] == again["rows_read"] == 1500
    assert (first["batches"], both["batches"], again["batches"]) == (1, 2, 2)
    assert read_raw(spark, base).count() == 1500


@pytest.mark.parametrize("dies_in", ["replace_stream_load", "replace_batch_report"])
def test_resumed_run_loads_nothing_twice(spark, base, files, monkeypatch, dies_in):
    """Die in the second batch, before or after its rows are stored, then resume."""
    working = getattr(ingest, dies_in)
    calls = []

    def dying(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return working(*args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, dies_in, dying)
        with pytest.raises(Exception, match="lost"):
            ingest_stream(spark, files, base, "r1", max_files=1)
    report = ingest_stream(spark, files, base, "r1", max_files=1)
    assert report["rows_read"] == 1500 and report["batches"] == 5
    ingest_files(spark, files, f"{base}/b", "r1")
    assert same(rows(spark, base), rows(spark, f"{base}/b"))


def test_stream_by_header(spark, base, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("﻿ status ,order_id\nnew,1\n", encoding="utf-8")
    (folder / "2.csv").write_text("﻿ status ,order_id\n,2\n", encoding="utf-8")
    ingest_stream(spark, str(folder), base, "r1", by_header=True)
    found = rows(spark, base).collect()
    assert {(r["order_id"], r["status"], r["city"]) for r in found} == {
        ("1", "new", None), ("2", None, None),
    }


def test_stream_of_files_with_different_headers(spark, base, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1 [x].csv").write_text("status,order_id\nnew,1\nold,2\n", encoding="utf-8")
    (folder / "2.csv").write_text("order_id,note,status\n3,n,new\n", encoding="utf-8")
    first = ingest_stream(spark, str(folder), base, "r1", by_header=True, max_files=1)
    (folder / "3.csv").write_text("city\nCairo\n", encoding="utf-8")
    both = ingest_stream(spark, str(folder), base, "r1", by_header=True)
    assert (first["rows_read"], first["batches"]) == (3, 2)
    assert (both["rows_read"], both["batches"]) == (4, 3)
    found = read_raw(spark, base).select("source_file", "source_row_number", "raw_record.*", "extra").collect()
    assert sorted(
        (r["source_file"], r["source_row_number"], str(r["order_id"]), r["status"], r["city"], str(r["extra"])) for r in found
    ) == [
        ("1 [x].csv", 1, "1", "new", None, "None"),
        ("1 [x].csv", 2, "2", "old", None, "None"),
        ("2.csv", 1, "3", "new", None, "{'note': 'n'}"),
        ("3.csv", 1, "None", None, "Cairo", "None"),
    ]
