from __future__ import annotations

import random
import re

import numpy as np

from orderlayers.llm import minhash
from orderlayers.llm.minhash import keep_one_of_each, minhash_components, sketches


def brute(rows, n=2, percent=80):
    sets = []
    for _, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", lowered) if x]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label, strict=True):
        least[x] = min(doc, least.get(x, doc))
    return {doc: (len(s), least[x]) for (doc, _), s, x in zip(rows, sets, label, strict=True)}


def test_components_equal_brute_force(spark, docs):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    bases = [[r.choice(vocabulary) for _ in range(r.randrange(3, 80))] for _ in range(12)]
    rows = []
    for k in range(160):
        words = list(r.choice(bases))
        for _ in range(r.randrange(0, 4)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((1000 - k, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "two")]
    found = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in minhash_components(docs(*rows)).collect()}
    assert found == brute(rows)


def test_null_ids_repeats_and_extra_columns(docs):
    frame = docs((None, "a b c"), (4, "a b c"), (4, "a b c"), (3, "a b c"), (4, "other words here"))
    rows = minhash_components(frame.withColumnRenamed("source", "cls")).collect()
    found = sorted((str(x["doc_id"]), x["n_shingles"], x["component_id"], x["kept"]) for x in rows)
    assert found == [
        ("3", 2, 3, True), ("4", 2, 3, False), ("4", 2, 3, False), ("4", 2, 4, True), ("None", 2, None, True),
    ]


def test_stage_keeps_one_of_each_with_all_columns(docs):
    text = " ".join(f"t{k}" for k in range(60))
    frame = docs((9, text, "en", "s1"), (5, text + " end", "en", "s2"), (7, "short one", "de", "s3"), (8, None))
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == [5, 7, 8]


def test_sketches_fill_every_bin_and_estimate_similarity():
    r = np.random.default_rng(1)
    shared = r.integers(0, 1 << 63, 800, dtype=np.uint64)
    a, b = (np.concatenate([shared, r.integers(0, 1 << 63, 100, dtype=np.uint64)]) for _ in range(2))
    one = r.integers(0, 1 << 63, 1, dtype=np.uint64)
    found = sketches(np.concatenate([a, b, one]), np.array([900, 900, 1]), 400)
    assert (found != 0xFFFFFFFFFFFFFFFF).all()
    assert abs((found[0] == found[1]).mean() - 0.8) < 0.08


def test_stage_keeps_one_row_of_repeated_and_null_ids(docs):
    text = " ".join(f"t{k}" for k in range(60))
    frame = docs((1, text), (1, text), (None, text), (None, text), (2, text))
    frame = frame.withColumn("__gone", frame.doc_id).withColumn("key", frame.text).withColumn("extra_0", frame.text)
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert [x["doc_id"] for x in kept.collect()] == [1]
    rows = [(None, text), (None, text + " more"), (None, "other"), (None, "other"), (4, None), (4, None), (5, ""), (6, "")]
    kept = sorted(str(x["doc_id"]) for x in keep_one_of_each(docs(*rows)).collect())
    assert kept == ["4", "5", "6", "None", "None"]
    assert keep_one_of_each(docs((1, "x")).limit(0)).count() == 0


def test_buckets_of_one_member_are_not_moved(spark):
    """Only rows whose bucket is in the filter come out, whatever the sizes of the lists."""
    rows = [(k, 5, [k * 1000 + j for j in range(k % 4)] + [7]) for k in range(40)]
    frame = spark.createDataFrame(rows, "cls long, size long, bands array<long>")
    found, few = minhash._filter_of(spark.createDataFrame([(7,), (3001,)], "bucket long"), "bucket")
    shared = spark.sparkContext.broadcast(found)
    kept = frame.mapInArrow(minhash._shared_batches(shared), "cls long, size long, bucket long").collect()
    assert few and sorted(map(tuple, kept)) == sorted([(k, 5, 7) for k in range(40)] + [(3, 5, 3001)])


def test_full_filters_lose_no_link(docs, monkeypatch):
    monkeypatch.setattr(minhash, "FILTER_BITS", 5)
    r = random.Random(5)
    rows = [(k, " ".join(r.choice(["a b c d e f g h i j k l", "m n o p q r s t u v w x"]).split()[k % 2 :])) for k in range(30)]
    rows += [(100 + k, f"only {k} here") for k in range(30)]
    found = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in minhash_components(docs(*rows)).collect()}
    assert found == brute(rows)
