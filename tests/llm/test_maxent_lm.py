from __future__ import annotations

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlayers.llm import maxent_lm
from orderlayers.llm.maxent_lm import MaxentScorer, in_training


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [x for x in re.split("[\x20\x09-\x0d]+", lowered) if x]


def learns(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1


@pytest.mark.parametrize("head", [1 << 17, 500])
def test_counts_and_base_equal_brute_force_and_the_model_is_better(docs, small_docs, monkeypatch, head):
    monkeypatch.setattr(maxent_lm, "HEAD", head)
    odd = docs((None, None), (10**7, ""), (10**7 + 1, "unSEEN\x0bunseen the")).select("doc_id", "text")
    frame = small_docs.select("doc_id", "text").union(odd)
    scorer = MaxentScorer(frame.filter(in_training()))
    rows = scorer.score(frame).collect()
    texts = {x["doc_id"]: x["text"] for x in frame.collect()}
    counts, ends = Counter(), 0
    for doc_id, text in texts.items():
        if learns(doc_id):
            counts.update(split(text))
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + 1
    for row in rows:
        words = split(texts[row["doc_id"]])
        base = sum(math.log10((c + 0.5) / (total + 0.5 * (types + 1))) for c in [ends, *(counts[w] for w in words)])
        assert (row["n_tokens"], row["train_tokens"]) == (len(words) + 1, total)
        assert row["n_known"] == 1 + sum(w in counts for w in words)
        assert abs(row["base_score"] - base) < 1e-6
        assert row["score"] < 0
    if head > len(counts):  # a tenth of a MB is little to learn from with fewer outcomes
        assert sum(x["score"] for x in rows) > sum(x["base_score"] for x in rows)
    outcomes = np.arange(int(scorer.model.classes[-1]))
    for before, earlier in ((5, 9), (maxent_lm.START, maxent_lm.START)):
        chance = scorer.model.log10(np.full(len(outcomes), before), np.full(len(outcomes), earlier), outcomes)
        assert abs((10**chance).sum() - 1) < 1e-5


def test_nothing_to_learn_from(docs):
    frame = docs("some words", None)
    rows = MaxentScorer(frame.limit(0)).score(frame).orderBy("doc_id").collect()
    assert [(x["n_tokens"], x["n_known"], x["train_tokens"]) for x in rows] == [(3, 0, 0), (1, 0, 0)]
    assert all(abs(x["base_score"]) < 1e-9 for x in rows)


def test_the_context_counts_for_words_of_any_rank(docs):
    # Beyond a thousand words, each word is followed by one of its own in all texts but one.
    pairs = [(f"left{k}", f"right{k}") for k in range(3000)]
    order = np.random.default_rng(2).permutation(np.repeat(np.arange(3000), 20))
    lines = [" ".join(" ".join(pairs[k]) for k in part) for part in np.array_split(order, 100)]
    scorer = MaxentScorer(docs(*lines))
    told = docs("left7 right7 left2990 right2990", "left7 right2990 left2990 right7")
    fit, misfit = (x["score"] for x in scorer.score(told).orderBy("doc_id").collect())
    assert fit > misfit + 1
    assert len(scorer.model.classes) > 6000


def test_rare_words_move_the_words_after_them_and_have_buckets(docs, monkeypatch):
    monkeypatch.setattr(maxent_lm, "HEAD", 8)
    lines = [f"rare{k % 400} {'north' if k % 2 else 'south'} by the way" for k in range(4000)]
    scorer = MaxentScorer(docs(*lines))
    assert scorer.buckets > 1
    told = docs("rare7 north by the way", "rare7 south by the way")
    fit, misfit = (x["score"] for x in scorer.score(told).orderBy("doc_id").collect())
    assert fit > misfit


def test_no_round_leaves_its_changes_or_weights_on_disk(spark, docs):
    scorer = MaxentScorer(docs("some words", "more words than some"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        names = blocks.getAllFiles().mkString(" ").split(" ")
        return {n.rsplit("/", 1)[-1] for n in names if re.search(r"/(shuffle_[^/]*[.]data|broadcast_[^/]*_python)$", n)}

    before = kept()
    scorer._train(docs("some words", "more words than some"), scorer.model.tree)
    until = time.monotonic() + 20
    while kept() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not kept() - before


def test_training_reads_and_splits_its_texts_once_and_keeps_nothing(spark, docs):
    lines = ("some words", "more words than some")
    scorer = MaxentScorer(docs(*lines))
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    frame = docs(*lines).select("doc_id", counted.asNondeterministic()("text").alias("text"))
    model = scorer._train(frame, scorer.model.tree)
    assert read.value == len(lines)
    assert np.allclose(model.weights, scorer.model.weights, atol=1e-6)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_a_step_moves_each_weight_by_its_own_slope_and_curvature(monkeypatch):
    monkeypatch.setattr(maxent_lm, "AT_ONCE", 7)
    monkeypatch.setattr(maxent_lm, "WEIGHTS_AT_ONCE", 50)
    made = np.random.default_rng(3)
    tree = maxent_lm.Tree.of(made.random(40))
    model = maxent_lm.MaxentModel(tree, 8, made.random(256).astype(np.float32) - np.float32(0.5))
    before, earlier, outcome = (made.integers(0, n, 100) for n in (5, 6, 40))
    slope, bend = np.zeros(256), np.zeros(256)
    logs = np.zeros(100)
    constant = maxent_lm.mix(np.zeros(1, np.uint64))[0]
    for k in range(100):
        hashes = [constant, *(x[0] for x in maxent_lm._feature_hashes(before[k : k + 1], earlier[k : k + 1]))]
        for path in tree.paths[tree.marks[outcome[k]] : tree.marks[outcome[k] + 1]].tolist():
            node, right = divmod(path, 2)
            spread = node * int(maxent_lm._STEP) % (1 << 64)
            places = [((int(h) ^ spread) * int(maxent_lm._TURN) % (1 << 64)) >> 56 for h in hashes]
            chance = 1 / (1 + math.exp(-(tree.base[node] + sum(float(model.weights[p]) for p in places))))
            logs[k] += math.log10(chance if right else 1 - chance)
            for p in places:
                slope[p] += chance - right
                bend[p] += max(chance * (1 - chance), abs(chance - right) / 4)
    assert np.allclose(model.log10(before, earlier, outcome), logs)
    wanted = model.weights - 0.5 * slope / (1 + bend)
    sums, curvature = np.zeros(256, complex), np.zeros(256, np.float32)
    maxent_lm._step(model, sums, curvature, before, earlier, outcome, 0.5)
    assert np.allclose(model.weights, wanted, atol=1e-5)
    assert np.allclose(curvature, bend, atol=1e-4)
    assert not sums.any()


def test_words_are_those_between_six_kinds_of_white_space():
    texts = ["", " \t", "One", "\n A\x0bB\x0cc\r\r\tÄÉ \x1c\x1d\x1e\x1f\x85 \xa0 e f ", "\x00 x\x00Y", "last "]
    for made in (pa.array(texts), pa.array(["cut", *texts]).slice(1), pa.array(texts, pa.large_string())):
        words, lengths = maxent_lm._words(made)
        assert words.to_pylist() == [w for t in texts for w in split(t)]
        assert lengths.tolist() == [len(split(t)) for t in texts]
