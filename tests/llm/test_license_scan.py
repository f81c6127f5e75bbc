from __future__ import annotations

import re

from orderlayers.llm.license_scan import PASSAGES, PHRASES, license_scan


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        phrase = phrase.split()
        for at in range(len(words) - len(phrase) + 1):
            if words[at : at + len(phrase)] == phrase:
                places.append(at)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def result(row):
    return row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]


def test_base_equals_brute_force(docs, small_docs):
    odd = [
        None, "", "cc by", "CC BY NC cc by nc by nc", "under the_MIT-license; Apache License, Version 2.0",
        "Under the mit licensé", "x " * 3000 + "cc by nc " * 500,
    ]
    frame = docs(*((10**6 + k, t) for k, t in enumerate(odd))).select("doc_id", "text").union(
        small_docs.select("doc_id", "text")
    )
    texts = {x["doc_id"]: x["text"] for x in frame.collect()}
    rows = license_scan(frame).collect()
    assert len(rows) == len(texts)
    assert all(result(x) == brute(texts[x["doc_id"]]) for x in rows)


def test_passages_with_changes_get_the_labels_of_the_method(docs):
    passage = PASSAGES["mit"].upper().replace(" FREE OF", ", free oops of")
    row = license_scan(docs("words before " + passage)).first()
    assert (row["base_labels"], row["labels"]) == ("", "mit")
    assert 0.5 <= row["score"] < 1
    assert license_scan(docs(" ".join(PASSAGES["mit"].split()[:8]))).first()["labels"] == ""


def test_repeats_null_ids_and_clashing_columns(docs):
    frame = docs((1, "cc by nc"), (1, "cc by nc"), (1, "none"), (None, "cc by nc")).withColumnRenamed("source", "words")
    rows = license_scan(frame).collect()
    assert sorted((str(x["doc_id"]), x["n_base"]) for x in rows) == [("1", 0), ("1", 1), ("1", 1), ("None", 1)]
    assert license_scan(frame.limit(0)).count() == 0


def test_main_path_runs_no_python(docs):
    plan = license_scan(docs("a"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
