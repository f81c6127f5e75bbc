from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators import classify, number_rows, with_positions
from orderlayers.plans import ingest_files, sample, sample_rows, write_sample
from orderlayers.queries.dirty_orders import keyed_dirty_orders
from orderlayers.session import pinned_splits, scratch_path
from orderlayers.sources import (
    file_inventory,
    read_orders,
    read_orders_by_header,
    read_raw,
    write_orders_csv,
)
from orderlayers.sources.order_files import conform, first_lines, one_file_a_task, scans_by_header

HEADER = ",".join(S.ORDER_FIELDS)


def line(order_id: str, items: str = "[]") -> str:
    fields = dict.fromkeys(S.ORDER_FIELDS, "x") | {"order_id": order_id, "items_json": items}
    return ",".join(fields.values())


def write(path, *lines, end="\n"):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_bytes((end.join(lines) + end).encode())
    return str(path)


def test_doubled_quotes_blank_lines_short_and_long_rows(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        "\ufeff" + HEADER,
        line("a", '"[{""sku"":""P,1"",""qty"":2}]"'),
        "", "   ", "\t",
        "b,2024-01-01",
        line("c") + ",more,fields",
        line("d", '""'),
    )
    rows = read_orders(spark, path).orderBy("order_id").collect()
    assert [r["order_id"] for r in rows] == ["a", "b", "c", "d"]
    assert rows[0]["items_json"] == '[{"sku":"P,1","qty":2}]'
    assert rows[1]["order_date"] == "2024-01-01" and rows[1]["items_json"] is None
    assert rows[2]["items_json"] == "[]"
    assert rows[3]["items_json"] is None


def test_quoted_field_over_lines(spark, tmp_path):
    path = write(tmp_path / "o.csv", HEADER, line("a", '"[1,\n2]"'), line("b"))
    rows = read_orders(spark, path, multi_line=True).orderBy("order_id").collect()
    assert [r["items_json"] for r in rows] == ["[1,\n2]", "[]"]


def test_by_header_takes_any_column_order(spark, tmp_path):
    write(tmp_path / "in/1.csv", "\ufeff status ,order_id", "new,1", ",2")
    rows = conform(read_orders_by_header(spark, str(tmp_path / "in")))
    assert rows.columns == [*S.ORDER_FIELDS, "extra"]
    assert {(r["order_id"], r["status"], r["city"]) for r in rows.collect()} == {
        ("1", "new", None), ("2", None, None),
    }


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder / "1.csv", "order_id,status", "1,new")
    write(folder / "2 [a]+b%20.csv", "", "  ", "status,order_id,colour", "new,2,red", "", "old,3")
    write(folder / "3.csv", "order_id,status", "4,", "5,new")
    write(folder / "4.csv", "status,order_id")
    (folder / "5.csv").touch()
    assert len(scans_by_header(spark, str(folder))) == 3
    rows = conform(read_orders_by_header(spark, str(folder))).collect()
    assert sorted((r["order_id"], r["status"]) for r in rows if r["status"]) == [
        ("1", "new"), ("2", "new"), ("3", "old"), ("5", "new"),
    ]
    ingest_files(spark, str(folder), str(tmp_path / "layers"), "r1", by_header=True)
    stored = read_raw(spark, str(tmp_path / "layers")).collect()
    assert sorted(
        (r["source_file"], r["source_row_number"], r["raw_record"]["order_id"], str(r["extra"])) for r in stored
    ) == [
        ("1.csv", 1, "1", "None"),
        ("2 [a]+b%20.csv", 1, "2", "{'colour': 'red'}"),
        ("2 [a]+b%20.csv", 2, "3", "{'colour': None}"),
        ("3.csv", 1, "4", "None"),
        ("3.csv", 2, "5", "None"),
    ]


def test_one_header_is_one_scan_and_no_file_is_none(spark, tmp_path):
    write(tmp_path / "in/1.csv", "status,order_id", "new,1")
    write(tmp_path / "in/2.csv", "status,order_id", "old,2")
    assert len(scans_by_header(spark, str(tmp_path / "in"))) == 1
    (tmp_path / "none").mkdir()
    (tmp_path / "none/1.csv").touch()
    assert conform(read_orders_by_header(spark, str(tmp_path / "none"))).isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scans_by_header(spark, str(tmp_path / "missing"))


def test_headers_are_found_without_reading_the_files(spark, tmp_path):
    body = [line(str(k)) for k in range(50_000)]
    for k in range(3):
        write(tmp_path / f"in/{k}.csv", HEADER, *body)
    with one_file_a_task(spark):
        lines = first_lines(spark, str(tmp_path / "in"))
        assert lines.rdd.getNumPartitions() == 3
        assert [r["line"] for r in lines.collect()] == [HEADER] * 3


def test_csv_round_trip(spark, tmp_path, small):
    rows = keyed_dirty_orders(spark, small).drop("k")
    path = str(tmp_path / "csv")
    write_orders_csv(rows, path)
    expected = rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in rows.columns])
    back = read_orders(spark, path)
    assert back.exceptAll(expected).isEmpty() and expected.exceptAll(back).isEmpty()
    counts = {r[0]: r[1] for r in classify(back).groupBy("record_status").count().collect()}
    assert counts == {
        "Corrected": 761, "Valid": 624, "Quarantined: CORRUPTED_ITEMS_JSON": 26,
        "Quarantined: MISSING_CUSTOMER_ID": 43, "Quarantined: MISSING_ORDER_ID": 32,
        "Quarantined: UNKNOWN_PRICE": 14,
    }


@pytest.fixture
def numbered_files(tmp_path):
    """Files of unequal length whose order ids tell file and line."""
    lengths = {"a.csv": 500, "b.csv": 1, "c.csv": 1700, "d.csv": 0}
    for name, length in lengths.items():
        write(
            tmp_path / "in" / name,
            HEADER,
            *[text for i in range(1, length + 1) for text in (line(f"{name}:{i}"), "")],
        )
    return str(tmp_path / "in"), lengths


@pytest.fixture
def many_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_numbers_per_file(spark, numbered_files, many_splits):
    path, lengths = numbered_files
    scan = read_orders(spark, path)
    assert scan.rdd.getNumPartitions() > 20
    rows = number_rows(with_positions(scan), scratch_path(spark, "sizes"))
    found = rows.select("order_id", "__name", "source_row_number").collect()
    assert len(found) == sum(lengths.values())
    assert all(r["order_id"] == f"{r['__name']}:{r['source_row_number']}" for r in found)


def test_numbers_through_all_files_and_sample(spark, numbered_files, many_splits, tmp_path):
    path, _ = numbered_files
    first = sample_rows(spark, path, 503).orderBy("source_row_number").collect()
    expected = [f"a.csv:{i}" for i in range(1, 501)] + ["b.csv:1", "c.csv:1", "c.csv:2"]
    assert [r["order_id"] for r in first] == expected
    output = str(tmp_path / "sample")
    write_sample(spark, path, output, 503)
    assert [r["order_id"] for r in read_orders(spark, output).collect()] == expected


def test_changed_splits_fail_instead_of_numbering_wrongly(spark, numbered_files, many_splits):
    path, _ = numbered_files
    rows = number_rows(with_positions(read_orders(spark, path)), scratch_path(spark, "sizes"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    with pytest.raises(Exception, match="input splits changed"):
        rows.collect()


def test_pinned_splits_set_and_restore(spark):
    key = "spark.sql.files.minPartitionNum"
    assert spark.conf.get(key, None) is None
    with pinned_splits(spark):
        assert spark.conf.get(key) == str(spark.sparkContext.defaultParallelism)
    assert spark.conf.get(key, None) is None


def test_numbering_moves_no_rows(spark, numbered_files):
    path, _ = numbered_files
    rows = number_rows(with_positions(read_orders(spark, path)), scratch_path(spark, "sizes"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("FileScan csv")]
    assert "BroadcastHashJoin" in above and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in above and "Exchange rangepartitioning" not in above


def test_sample_reads_only_the_files_it_needs(spark, numbered_files, monkeypatch):
    path, _ = numbered_files
    read = []

    def spied(session, paths, *args, **kwargs):
        read.append([p.rsplit("/", 1)[-1] for p in paths])
        return read_orders(session, paths, *args, **kwargs)

    monkeypatch.setattr(sample, "read_orders", spied)
    assert sample_rows(spark, path, 400).count() == 400
    assert read == [["a.csv"], ["a.csv"]]


def test_inventory(spark, tmp_path):
    write(tmp_path / "in/sm all+.csv", "x" * 99)
    write(tmp_path / "in/large.csv", "x" * 1999)
    rows = file_inventory(spark, str(tmp_path / "in"), threshold_mb=100 / 2**20)
    assert {(r["file_name"], r["length"], r["engine"]) for r in rows.collect()} == {
        ("sm all+.csv", 100, "python_batch"), ("large.csv", 2000, "pyspark"),
    }
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        file_inventory(spark, str(tmp_path / "none"))
