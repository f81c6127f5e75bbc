from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderlayers.llm.common import stored
from orderlayers.llm.queries import QUERIES


def test_stages_work_on_what_is_left_and_their_decisions_take_effect(spark, small, small_docs):
    bench = spark.read.parquet(f"{small}/benchmark.parquet").first()["text"]
    text = small_docs.filter("lang = 'en' and n_chars > 2000").orderBy("doc_id").first()["text"]
    more = [
        (10**6, "1234 !!!", "en"), (10**6 + 1, text + " end", "en"), (10**6 + 2, f"The {bench} of", "en"),
        (10**6 + 3, "The mail of the one is some.one@example.com and that is it.", "en"), (10**6 + 4, None, None),
    ]
    frame = small_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stored(stage(spark, frame, small), name)
        ids[name] = {x["doc_id"] for x in frame.select("doc_id").collect()}
        if name != "tokens":
            assert frame.columns == before.columns
    assert not {10**6, 10**6 + 4} & ids["language_id"]
    assert 10**6 + 1 in ids["language_id"] and 10**6 + 1 not in ids["near_duplicates"]
    assert 10**6 + 2 in ids["near_duplicates"] and 10**6 + 2 not in ids["decontamination"]
    assert ids["tokens"] == ids["personal_data"] == ids["decontamination"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    row = frame.filter(F.col("doc_id") == 10**6 + 3).first()
    expected = tokenizer.encode("The mail of the one is <EMAIL> and that is it.", add_special_tokens=False).ids
    assert np.array(row["ids"]).tolist() == expected


def test_run_and_registration(spark, small):
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_stages_on_empty_tables(spark, small, small_docs):
    frame = small_docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, small), name)
        assert frame.count() == 0
        assert name == "tokens" or frame.columns == small_docs.columns
