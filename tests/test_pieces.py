"""Memory of a task: raw rows are stored unsorted, and the work table is merged piece by piece."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.plans import elt, run_elt
from orderlayers.queries.dirty_orders import enveloped_orders
from orderlayers.sources import append_raw, raw_path, read_layer, read_raw

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.mark.parametrize("runs", [1, 3])
def test_raw_rows_are_stored_without_a_sort(spark, base, small, monkeypatch, runs):
    plain, writers = DataFrameWriter.parquet, []

    def parquet(self, path, *args, **kwargs):
        writers.append(int(spark.conf.get(WRITERS)))
        plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(WRITERS)
    run_id = F.concat(F.lit("r"), (F.col("source_row_number") % runs).cast("string"))
    rows = enveloped_orders(spark, small).withColumn("run_id", run_id)
    append_raw(rows, raw_path(spark, base))
    assert writers == [2] and spark.conf.get(WRITERS) == before
    told = read_raw(spark, base).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in told} == {f"r{k}": 1500 // runs for k in range(runs)}


def test_work_table_is_merged_in_pieces(spark, base, small, monkeypatch):
    monkeypatch.setattr(elt, "PIECE_BYTES", 4096, raising=False)
    plain, pieces = elt.upsert, {}

    def upsert(spark, base, layer, incoming, *args):
        sizes = incoming.groupBy(F.spark_partition_id()).count().collect()
        pieces[layer] = [row["count"] for row in sizes]
        return plain(spark, base, layer, incoming, *args)

    monkeypatch.setattr(elt, "upsert", upsert)
    append_raw(enveloped_orders(spark, small).coalesce(1), raw_path(spark, base))
    report = run_elt(spark, base, "e1")
    assert len(pieces[S.VALIDATED]) > 4 and max(pieces[S.VALIDATED]) <= 400
    assert sum(map(sum, pieces.values())) == report["rows_read"] == 1500
    assert read_layer(spark, base, S.VALIDATED).count() == report["inserted_keys"]
