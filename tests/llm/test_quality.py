from __future__ import annotations

import random

from orderlayers.llm.quality import grade_documents, train_grade_model


def rated(spark, docs, n=600):
    r = random.Random(1)
    words = [f"w{k}" for k in range(200)]
    rows, labels = [], []
    for k in range(n):
        text = [r.choice(words) for _ in range(r.randrange(20, 60))]
        grade = k % 3
        if grade == 0:
            text[r.randrange(len(text))] = r.choice(["vile", "scum"])
        if grade == 1:
            text = [f"{w}###" for w in text]
        rows.append((k, " ".join(text)))
        labels.append((k, int(grade == 2), int(grade == 0)))
    return docs(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_grades_are_told_apart(spark, docs):
    texts, labels = rated(spark, docs)
    model = train_grade_model(texts, labels.filter("doc_id < 480"))
    assert model.thresholds[0] < model.thresholds[1]
    rows = [x for x in grade_documents(texts, model).collect() if x["doc_id"] >= 480]
    assert sum(x["kept"] == (x["doc_id"] % 3 == 2) for x in rows) >= 0.9 * len(rows)
    assert sum((x["p_above_0"] < 0.5) == (x["doc_id"] % 3 == 0) for x in rows) >= 0.9 * len(rows)
    for x in rows:
        assert x["p_above_0"] >= x["p_above_1"]
        assert abs(x["expected_grade"] - x["p_above_0"] - x["p_above_1"]) < 1e-9


def test_edge_rows(spark, docs):
    texts, labels = rated(spark, docs, 60)
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, None), (999, 1, 0)], labels.schema)
    model = train_grade_model(texts, labels.union(odd).union(labels))
    frame = docs(None, "", (None, "text"), (3, "same"), (3, "same"))
    rows = grade_documents(frame, model).collect()
    assert len(rows) == 5
    assert len({x["expected_grade"] for x in rows if x["doc_id"] == 3}) == 1
    assert train_grade_model(texts, labels.limit(0)) is None
    assert [x["kept"] for x in grade_documents(frame, None).collect()] == [True] * 5
    assert grade_documents(frame.limit(0), model).count() == 0
