from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from orderlayers import schema as S
from orderlayers.operators import classify_accepted, latest_per_key, upsert_counts
from orderlayers.plans import (
    ingest_files,
    load_orders,
    preview_layers,
    reset_layers,
    run_elt,
)
from orderlayers.plans import elt
from orderlayers.plans.elt import check_report
from orderlayers.queries.dirty_orders import enveloped_orders
from orderlayers.queries.registry import _even, _order_files, _with_copies
from orderlayers.sources import (
    append_raw,
    drop_old_versions,
    existing_keys,
    keyed_layers,
    raw_path,
    read_layer,
    read_raw,
    read_reports,
    upsert,
)
from orderlayers.sources.ledger import new_runs
from orderlayers.sources.publications import current_version


def same(left, right) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture
def kept(spark, small):
    return classify_accepted(enveloped_orders(spark, small))


def test_golden_upsert(spark, base, kept):
    upsert(spark, base, S.VALIDATED, _even(kept), "r1")
    counts = upsert(spark, base, S.VALIDATED, _with_copies(kept), "r2")
    assert (counts["inserted_count"], counts["updated_count"]) == (675, 703)
    assert (counts["inserted_keys"], counts["updated_keys"]) == (675, 676)
    layer = read_layer(spark, base, S.VALIDATED)
    assert layer.schema == S.LAYER_SCHEMA
    assert layer.count() == 1351 and layer.filter("city = 'CITY-2'").count() == 27
    asked = upsert_counts(_even(kept).select("_id"), _with_copies(kept)).first()
    assert tuple(asked) == (675, 703, 675, 676)


def test_second_upsert_changes_nothing(spark, base, kept):
    upsert(spark, base, S.VALIDATED, kept, "r1")
    before = read_layer(spark, base, S.VALIDATED)
    counts = upsert(spark, base, S.VALIDATED, kept, "r2")
    assert counts["inserted_keys"] == 0 and counts["unchanged_count"] == 1351
    assert same(before, read_layer(spark, base, S.VALIDATED))


@pytest.mark.parametrize("buckets", [1, 7])
def test_bucket_counts_may_change(spark, base, kept, buckets):
    upsert(spark, base, S.VALIDATED, _even(kept), "r1")
    counts = upsert(spark, base, S.VALIDATED, kept, "r2", buckets=buckets)
    assert (counts["inserted_keys"], counts["updated_keys"]) == (675, 676)
    upsert(spark, base, S.VALIDATED, kept, "r3")
    assert same(read_layer(spark, base, S.VALIDATED), kept.select(*S.LAYER_SCHEMA.names))


@pytest.mark.parametrize("buckets", [3, 4, 8])
def test_upsert_shuffles_the_incoming_rows_once(spark, base, kept, monkeypatch, buckets):
    """The plan that the write runs, with fewer, as many and more buckets than partitions."""
    upsert(spark, base, S.VALIDATED, kept, "r1", buckets=buckets)
    plans = []
    write = type(kept).write

    def spied(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write.fget(frame)

    monkeypatch.setattr(type(kept), "write", property(spied))
    upsert(spark, base, S.VALIDATED, kept, "r2", buckets=buckets)
    [plan] = [p for p in plans if "FullOuter" in p]
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert f"Exchange hashpartitioning(_id, {buckets})" in re.sub(r"#\d+L?", "", plan)


def test_bucket_count_has_no_upper_bound_of_its_own():
    count = keyed_layers.bucket_count
    assert count(None, 8) == 8 and count(1, 8) == 1 and count(12_000, 8) == 3
    assert count(150_000, 8) == 8 and count(20_000_000_000, 200) == 20_000
    assert count(1, 8, stored=5) == 5


def test_unpublished_version_is_never_seen(spark, base, kept, monkeypatch):
    upsert(spark, base, S.VALIDATED, _even(kept), "r1")
    before = read_layer(spark, base, S.VALIDATED).count()

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(keyed_layers, "publish", die)
        with pytest.raises(RuntimeError, match="lost"):
            upsert(spark, base, S.VALIDATED, kept, "r2")
    assert read_layer(spark, base, S.VALIDATED).count() == before
    upsert(spark, base, S.VALIDATED, kept, "r2")
    assert read_layer(spark, base, S.VALIDATED).count() == 1351


def test_nothing_incoming_publishes_nothing(spark, base, kept):
    counts = upsert(spark, base, S.VALIDATED, kept.filter("false"), "r1", {"n": F.lit(True)})
    assert counts["incoming_keys"] == 0 and counts["n"] == 0
    assert existing_keys(spark, base, S.VALIDATED).isEmpty()
    upsert(spark, base, S.VALIDATED, kept, "r2")
    counts = upsert(spark, base, S.VALIDATED, kept.filter("city = 'nowhere'"), "r3")
    assert counts["incoming_keys"] == 0 and counts["layer_rows"] == 1351
    assert len(_files(base)) == 1
    assert read_layer(spark, base, S.VALIDATED).count() == 1351


def test_first_upsert_reads_its_rows_once(spark, base, kept):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        read.add(1)
        return value

    rows = kept.withColumn("_id", seen.asNondeterministic()("_id"))
    assert upsert(spark, base, S.VALIDATED, rows, "r1")["inserted_keys"] == 1351
    assert read.value == 1351


def test_hot_key_keeps_newest_and_counts_all(spark, base, kept):
    """A third of all rows under one key."""
    hot = kept.limit(1).crossJoin(spark.range(700).withColumnRenamed("id", "n")).select(
        F.lit("HOT").alias("_id"),
        *[c for c in kept.columns if c not in ("_id", "source_row_number")],
        (F.col("n") * 10).alias("source_row_number"),
    )
    rows = kept.unionByName(hot)
    assert latest_per_key(rows).filter("_id = 'HOT'").first()["source_row_number"] == 6990
    counts = upsert(spark, base, S.VALIDATED, rows, "r1")
    assert counts["inserted_count"] == 1351 + 700 and counts["inserted_keys"] == 1352


def test_ties_are_settled_the_same_way(spark, kept):
    row = kept.limit(1)
    twins = row.withColumn("city", F.lit("A")).union(row.withColumn("city", F.lit("B")))
    for rows in (twins, twins.orderBy("city"), twins.orderBy(F.desc("city"))):
        assert latest_per_key(rows).first()["city"] == "B"


def test_partial_aggregation_comes_before_the_shuffle(kept):
    plan = latest_per_key(kept)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def elt_on(spark, base, small, copies=1):
    for _ in range(copies):
        append_raw(enveloped_orders(spark, small), raw_path(spark, base))


def test_elt_reports_and_layers(spark, base, small):
    elt_on(spark, base, small)
    report = run_elt(spark, base, "r1")
    assert (report["valid_count"], report["corrected_count"]) == (602, 749)
    assert report["quarantine_count"] == 149 == sum(report["error_case_counts"].values())
    assert report["error_case_counts"][S.UNKNOWN_PRICE] == 27
    assert report["null_date_count"] == 184
    assert (report["inserted_count"], report["updated_count"]) == (1351, 0)
    assert read_layer(spark, base, S.VALIDATED).count() == 1351
    held = read_layer(spark, base, S.QUARANTINE)
    assert held.count() == report["quarantine_keys"] == 149
    assert held.filter("_id like 'q\\_%'").count() == 32
    stored = read_reports(spark, base).first()
    assert stored["rows_read"] == 1500 and stored["error_case_counts"] == report["error_case_counts"]


def test_elt_again_inserts_nothing_and_scales_with_copies(spark, base, small):
    elt_on(spark, base, small)
    first = run_elt(spark, base, "r1")
    before = {layer: read_layer(spark, base, layer) for layer in (S.VALIDATED, S.QUARANTINE)}
    elt_on(spark, base, small, copies=2)
    third = run_elt(spark, base, "r2")
    for field in ("rows_read", "valid_count", "corrected_count", "quarantine_count"):
        assert third[field] == 3 * first[field]
    assert third["inserted_count"] == 0 and third["updated_count"] == 3 * 1351
    assert third["unchanged_count"] == third["updated_keys"] == 1351
    for layer, rows in before.items():
        assert same(rows, read_layer(spark, base, layer))


def test_half_loaded_layer_splits_the_counts(spark, base, small, kept):
    upsert(spark, base, S.VALIDATED, _even(kept), "r0")
    elt_on(spark, base, small)
    report = run_elt(spark, base, "r1")
    assert (report["inserted_count"], report["updated_count"]) == (675, 676)


def test_kept_classification_gives_the_same(spark, base, small):
    elt_on(spark, base, small)
    timed = ("run_id", "elapsed_seconds", "throughput")
    plain = run_elt(spark, base, "r1")
    for layer in (S.VALIDATED, S.QUARANTINE):
        keyed_layers.reset_layer(spark, base, layer)
    held = run_elt(spark, base, "r2", storage=StorageLevel.MEMORY_AND_DISK)
    assert {k: v for k, v in plain.items() if k not in timed} == {
        k: v for k, v in held.items() if k not in timed
    }


def test_elt_on_nothing(spark, base):
    assert run_elt(spark, base, "r1") is None
    assert read_reports(spark, base).isEmpty()


def test_fixed_order_leaves_its_quarantine_row(spark, base, orders):
    def load(change, run):
        rows = orders(change).select(
            F.lit(run).alias("run_id"), F.lit("f").alias("source_file"),
            F.lit(1).cast("long").alias("source_row_number"),
            F.current_timestamp().alias("ingested_at"), F.lit("e").alias("engine_used"),
            F.struct(*S.ORDER_FIELDS).alias("raw_record"),
        )
        append_raw(rows, raw_path(spark, base))
        return run_elt(spark, base, run, run_ids=[run])

    assert load({"customer_id": None}, "r1")["quarantine_count"] == 1
    assert load({}, "r2")["inserted_count"] == 1
    assert load({"city": "Giza"}, "r3")["updated_count"] == 1
    assert read_layer(spark, base, S.QUARANTINE).count() == 1
    assert read_layer(spark, base, S.VALIDATED).first()["city"] == "Giza"


def test_ingest_elt_and_run_filter(spark, base, small):
    files = _order_files(spark, small, files=3)
    ingested, elt = load_orders(spark, files, base, "r1")
    assert ingested["rows_read"] == ingested["raw_loaded"] == 1500
    assert ingested["source_file_count"] == elt["source_file_count"] == 3
    assert ingested["file_name"] == elt["file_name"]
    ingest_files(spark, files, base, "r2", contiguous=False)
    assert read_raw(spark, base).count() == 3000
    only = read_raw(spark, base, ["r2"])
    assert only.count() == 1500 == only.select("source_row_number").distinct().count()
    assert only.inputFiles() and all("/run_id=r2/" in file for file in only.inputFiles())
    assert read_raw(spark, base, ["r0"]).count() == 0
    assert read_raw(spark, base, ["r0", "r2", "r2"]).count() == 1500
    third = run_elt(spark, base, "r3", run_ids=["r2"])
    assert third["rows_read"] == 1500 and third["unchanged_count"] == 1385
    assert read_reports(spark, base).count() == 4
    numbers = read_raw(spark, base, ["r1"]).groupBy("source_file").agg(
        F.min("source_row_number"), F.max("source_row_number"), F.count(F.lit(1))
    )
    assert all(first == 1 and last == rows for _, first, last, rows in numbers.collect())


def test_run_ids_that_name_no_folder(spark, base, small):
    with pytest.raises(ValueError, match="run id"):
        ingest_files(spark, small, base, "a/b")


def test_report_check():
    good = dict(rows_read=3, valid_count=1, corrected_count=1, quarantine_count=1,
                inserted_count=2, updated_count=0)
    check_report(good)
    for field in ("rows_read", "inserted_count"):
        with pytest.raises(RuntimeError):
            check_report({**good, field: 9})


def test_preview_and_reset(spark, base, small):
    elt_on(spark, base, small)
    run_elt(spark, base, "r1")
    previews = preview_layers(spark, base, rows=5, repeatable=True)
    assert all(df.count() == 5 and "_id" not in df.columns for df in previews.values())
    reset_layers(spark, base)
    assert all(df.isEmpty() for df in preview_layers(spark, base).values())
    assert run_elt(spark, base, "r2") is None
    elt_on(spark, base, small)
    assert run_elt(spark, base, "r3")["inserted_count"] == 1351


def test_old_versions_go_and_current_stays(spark, base, kept):
    assert drop_old_versions(spark, base, S.VALIDATED) == []
    for run in ("r1", "r2", "r3"):
        upsert(spark, base, S.VALIDATED, kept, run)
    assert len(drop_old_versions(spark, base, S.VALIDATED, keep=2)) == 1
    assert len(drop_old_versions(spark, base, S.VALIDATED)) == 1
    assert read_layer(spark, base, S.VALIDATED).count() == 1351


def test_bucket_count_follows_size_and_never_shrinks(spark, base, kept, monkeypatch):
    monkeypatch.setattr(keyed_layers, "LEAST_ROWS", 500)

    def buckets_after(run, **sizes):
        upsert(spark, base, S.VALIDATED, kept, run, **sizes)
        return current_version(spark, base, S.VALIDATED)["buckets"]

    assert buckets_after("r1", expected_rows=1351) == 3
    assert buckets_after("r2", expected_rows=10) == 3
    assert buckets_after("r3") == 4
    assert buckets_after("r4", expected_rows=10**5) == 4
    assert buckets_after("r5", buckets=2) == 2
    assert read_layer(spark, base, S.VALIDATED).count() == 1351


def _files(base, layer=S.VALIDATED):
    found = {}
    for folder, _, files in os.walk(f"{base}/{layer}/data"):
        for file in files:
            if file.endswith(".parquet"):
                version, bucket = re.search(r"layer_version=(\S+)/layer_bucket=(\d+)", folder).groups()
                found.setdefault(version, set()).add(int(bucket))
    return found


def test_one_key_writes_one_bucket(spark, base, kept):
    upsert(spark, base, S.VALIDATED, kept, "r1", buckets=8)
    [first] = _files(base)
    key = kept.orderBy("_id").first()["_id"]
    one = kept.filter(F.col("_id") == key).withColumn("city", F.lit("Giza"))
    counts = upsert(spark, base, S.VALIDATED, one, "r2")
    assert (counts["inserted_keys"], counts["updated_keys"], counts["layer_rows"]) == (0, 1, 1351)
    written = {version: places for version, places in _files(base).items() if version != first}
    [(second, places)] = written.items()
    assert len(places) == 1
    expected = kept.withColumn("city", F.when(F.col("_id") == key, "Giza").otherwise(F.col("city")))
    assert same(read_layer(spark, base, S.VALIDATED), expected.select(*S.LAYER_SCHEMA.names))
    # A new key, and a key that moves nothing else; then the dead bucket's files go.
    new = one.withColumn("_id", F.lit("ORD-new"))
    counts = upsert(spark, base, S.VALIDATED, new, "r3")
    assert (counts["inserted_keys"], counts["layer_rows"]) == (1, 1352)
    before = read_layer(spark, base, S.VALIDATED).orderBy("_id").collect()
    assert sum(map(len, _files(base).values())) == 10
    drop_old_versions(spark, base, S.VALIDATED)
    assert sum(map(len, _files(base).values())) == 8
    assert read_layer(spark, base, S.VALIDATED).orderBy("_id").collect() == before
    # All buckets anew once their number changes.
    upsert(spark, base, S.VALIDATED, one, "r4", buckets=3)
    assert read_layer(spark, base, S.VALIDATED).orderBy("_id").collect() == before


def test_small_upsert_reads_its_buckets_only(spark, base, kept, monkeypatch):
    upsert(spark, base, S.VALIDATED, kept, "r1", buckets=8)
    one = kept.orderBy("_id").limit(1)
    read = keyed_layers.read_buckets
    frames = []
    monkeypatch.setattr(keyed_layers, "read_buckets", lambda *a: frames.append(read(*a)) or frames[-1])
    upsert(spark, base, S.VALIDATED, one, "r2")
    plan = frames[0]._jdf.queryExecution().executedPlan()
    frames[0].collect()
    files = re.search(r"PartitionFilters: \[.*layer_bucket", plan.toString())
    assert files and len(set(frames[0].inputFiles())) == 8
    assert frames[0].select(keyed_layers.bucket_of(8)).distinct().count() == 1


def test_keys_that_change_between_two_reads_fail(spark, base, kept, monkeypatch):
    upsert(spark, base, S.VALIDATED, kept, "r1", buckets=8)
    other = kept.orderBy(F.desc("_id")).limit(20)
    monkeypatch.setattr(keyed_layers, "latest_per_key", lambda *a: latest_per_key(other))
    with pytest.raises(RuntimeError, match="other keys"):
        upsert(spark, base, S.VALIDATED, kept.orderBy("_id").limit(1), "r2")
    assert same(read_layer(spark, base, S.VALIDATED), kept.select(*S.LAYER_SCHEMA.names))


def test_elt_scans_the_raw_layer_once(spark, base, small, monkeypatch):
    elt_on(spark, base, small)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    from orderlayers.plans import elt

    raw = read_raw(spark, base)
    monkeypatch.setattr(elt, "read_raw", lambda *a: raw.mapInArrow(counted, raw.schema))
    assert run_elt(spark, base, "r1")["rows_read"] == 1500
    assert seen.value == 1500


def _run(spark, base, rows, run_id):
    append_raw(rows.withColumn("run_id", F.lit(run_id)), raw_path(spark, base))


def test_new_runs_only(spark, base, small, monkeypatch):
    rows = enveloped_orders(spark, small)
    later = _even(rows).withColumn("source_row_number", F.col("source_row_number") + 10**6)
    _run(spark, base, later, "r1")
    _run(spark, base, rows, "r2")
    assert run_elt(spark, base, "e1", only_new=True)["rows_read"] == 2250
    assert run_elt(spark, base, "e2", only_new=True) is None
    whole = read_layer(spark, base, S.VALIDATED)
    # Older rows in a later run replace nothing; only that run is read.
    asked = []
    monkeypatch.setattr(elt, "read_raw", lambda *a: asked.append(a[2]) or read_raw(*a))
    _run(spark, base, _even(rows), "r3")
    report = run_elt(spark, base, "e3", only_new=True)
    assert report["rows_read"] == 750 and asked == [["r3"]]
    assert report["updated_keys"] == report["unchanged_count"] > 0 == report["inserted_keys"]
    assert same(whole, read_layer(spark, base, S.VALIDATED))
    # A run that has grown is taken again.
    _run(spark, base, rows, "r1")
    assert run_elt(spark, base, "e4", only_new=True)["rows_read"] == 2250
    assert same(whole, read_layer(spark, base, S.VALIDATED))
    # The same as one ELT over everything.
    other = raw_path(spark, base)
    monkeypatch.setattr(elt, "read_raw", lambda *a: spark.read.parquet(other).select(*S.RAW_ENVELOPE.names))
    run_elt(spark, f"{base}-2", "e1")
    drop = ("run_id",)
    assert same(whole.drop(*drop), read_layer(spark, f"{base}-2", S.VALIDATED).drop(*drop))


def test_emptied_layers_void_the_ledger(spark, base, small):
    _run(spark, base, enveloped_orders(spark, small), "r1")
    run_elt(spark, base, "e1", only_new=True)
    keyed_layers.reset_layer(spark, base, S.QUARANTINE)
    assert run_elt(spark, base, "e2", only_new=True)["quarantine_count"] > 0
    reset_layers(spark, base)
    assert new_runs(spark, base) == [] and run_elt(spark, base, "e3", only_new=True) is None
    _run(spark, base, enveloped_orders(spark, small), "r1")
    assert run_elt(spark, base, "e4", only_new=True)["rows_read"] == 1500


def test_elt_that_dies_before_the_ledger_is_done_again(spark, base, small, monkeypatch):
    _run(spark, base, enveloped_orders(spark, small), "r1")
    with monkeypatch.context() as patch:
        patch.setattr(elt, "record_merged", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_elt(spark, base, "e1", only_new=True)
    report = run_elt(spark, base, "e2", only_new=True)
    assert report["rows_read"] == 1500 and report["inserted_keys"] == 0
