from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.operators import classify_accepted
from orderlayers.queries.dirty_orders import enveloped_orders
from orderlayers.queries.registry import _even
from orderlayers.sources import (
    drop_old_versions,
    key_filters,
    keyed_layers,
    may_be_stored,
    read_layer,
    stored_keys_among,
    upsert,
    write_key_filters,
)

BUCKETS = 8


@pytest.fixture
def kept(spark, small):
    return classify_accepted(enveloped_orders(spark, small))


@pytest.fixture
def layer(spark, base, kept):
    upsert(spark, base, S.VALIDATED, _even(kept), "r1", buckets=BUCKETS)
    assert write_key_filters(spark, base, S.VALIDATED) == BUCKETS
    return base


def ids(df):
    return {row["_id"] for row in df.collect()}


def test_every_stored_key_is_found_and_few_others_seem_to_be(spark, layer, kept):
    stored = ids(read_layer(spark, layer, S.VALIDATED))
    strange = kept.select(F.concat(F.lit("ORD-1"), "_id").alias("_id"))
    assert ids(may_be_stored(spark, layer, S.VALIDATED, kept)) >= stored
    assert may_be_stored(spark, layer, S.VALIDATED, strange).count() < 0.05 * strange.count()
    asked = kept.select("_id").unionByName(strange).unionByName(kept.select("_id"))
    found = stored_keys_among(spark, layer, S.VALIDATED, asked)
    assert found.count() == len(stored) and ids(found) == stored


def test_buckets_that_hold_no_key_are_not_read(spark, layer, kept, monkeypatch):
    asked = []
    real = key_filters.read_buckets
    monkeypatch.setattr(key_filters, "read_buckets", lambda *a: asked.append(a[4]) or real(*a))
    one = _even(kept).orderBy("_id").limit(1)
    found = stored_keys_among(spark, layer, S.VALIDATED, one)
    assert found.count() == 1 and len(asked.pop()) == 1
    plan = found._jdf.queryExecution().toString()
    assert len(re.findall("layer_bucket", plan)) > 0
    beyond = kept.select(F.concat(F.lit("ZZZ"), "_id").alias("_id"))
    assert stored_keys_among(spark, layer, S.VALIDATED, beyond).isEmpty() and asked.pop() == []


def test_only_new_buckets_get_filters_and_those_without_are_read(spark, layer, kept):
    assert write_key_filters(spark, layer, S.VALIDATED) == 0
    odd = kept.filter(F.col("source_row_number") % 2 == 0).orderBy("_id").limit(1)
    upsert(spark, layer, S.VALIDATED, odd, "r2")
    assert ids(stored_keys_among(spark, layer, S.VALIDATED, odd)) == ids(odd)
    assert write_key_filters(spark, layer, S.VALIDATED) == 1
    assert ids(stored_keys_among(spark, layer, S.VALIDATED, odd)) == ids(odd)
    stored = ids(read_layer(spark, layer, S.VALIDATED))
    assert ids(stored_keys_among(spark, layer, S.VALIDATED, kept)) == stored


def test_no_layer_empty_layer_and_null_keys(spark, base, kept):
    assert write_key_filters(spark, base, S.VALIDATED) == 0
    assert stored_keys_among(spark, base, S.VALIDATED, kept).isEmpty()
    upsert(spark, base, S.VALIDATED, kept.orderBy("_id").limit(1), "r1", buckets=4)
    assert write_key_filters(spark, base, S.VALIDATED) == 4
    nothing = kept.select(F.lit(None).cast("string").alias("_id"))
    assert stored_keys_among(spark, base, S.VALIDATED, nothing).isEmpty()
    assert stored_keys_among(spark, base, S.VALIDATED, kept).count() == 1
    keyed_layers.reset_layer(spark, base, S.VALIDATED)
    assert stored_keys_among(spark, base, S.VALIDATED, kept).isEmpty()


def test_filters_written_twice_and_dropped_with_their_version(spark, layer, kept, monkeypatch):
    with monkeypatch.context() as patch:  # a try that died before the ranges leaves words behind
        real = key_filters._append
        patch.setattr(key_filters, "_append", lambda rows, path: real(rows, path) if path.endswith("words") else 1 / 0)
        upsert(spark, layer, S.VALIDATED, kept, "r2")
        with pytest.raises(ZeroDivisionError):
            write_key_filters(spark, layer, S.VALIDATED)
    assert write_key_filters(spark, layer, S.VALIDATED) == BUCKETS
    assert len(drop_old_versions(spark, layer, S.VALIDATED)) == 1
    ranges = spark.read.parquet(f"{layer}/{S.VALIDATED}/keys/ranges")
    assert ranges.select("version").distinct().count() == 1
    assert stored_keys_among(spark, layer, S.VALIDATED, kept).count() == kept.select("_id").distinct().count()
