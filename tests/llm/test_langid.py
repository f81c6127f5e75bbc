from __future__ import annotations

import pyarrow as pa

from orderlayers.llm import langid
from orderlayers.llm.common import text_column


def test_held_out_accuracy_and_whole_result(spark, small_docs):
    held = langid.held_out()
    model = langid.train_language_model(small_docs.filter(~held))
    found = langid.predict_languages(small_docs, model).withColumn("held", held)
    rows = found.join(small_docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == small_docs.count()
    apart = [x for x in rows if x["held"]]
    assert sum(x["lang"] == x["lang_pred"] for x in apart) >= 0.95 * len(apart)
    assert all(0 <= x["score"] <= 1 for x in rows)


def test_edge_texts_ties_and_missing_labels(docs):
    frame = docs(None, "", "12 !", "hello there", "hello there")
    rows = langid.predict_languages(frame, None).orderBy("doc_id").collect()
    assert [(x["lang_pred"], x["score"]) for x in rows] == [("und", 0.0)] * 5
    assert langid.train_language_model(frame) is None
    assert langid.keep_known_languages(frame, None).count() == 5


def test_stage_drops_what_is_rejected_and_keeps_columns(spark, small_docs):
    model = langid.train_language_model(small_docs)
    more = spark.createDataFrame([(10**6, "123 456"), (10**6 + 1, None)], "doc_id long, text string")
    frame = small_docs.unionByName(more, allowMissingColumns=True).withColumn("guess", small_docs.n_chars)
    kept = langid.keep_known_languages(frame, model)
    assert kept.columns == frame.columns
    ids = {x["doc_id"] for x in kept.select("doc_id").collect()}
    assert not ids & {10**6, 10**6 + 1}
    assert len(ids) >= 0.98 * small_docs.count()


def test_subwords_lie_in_one_row():
    data, offsets = text_column(pa.array(["ab", "c", "", "de"]))
    sizes = {}
    for (buckets, marks), length in zip(langid.subwords(data, offsets), langid.LENGTHS, strict=True):
        sizes[length] = (marks[1:] - marks[:-1]).tolist()
        assert len(buckets) == marks[-1]
    assert sizes == {2: [1, 0, 0, 1], 3: [0] * 4, 4: [0] * 4}
