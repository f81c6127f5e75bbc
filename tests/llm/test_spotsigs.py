"""SpotSigs against a plain implementation."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from orderlayers.llm import spotsigs
from orderlayers.llm.queries import op11_fingerprints
from orderlayers.llm.spotsigs import common_words, compare_edited, likeness, spot_components

SMALL = "/root/testdata/sf0.001"


def word_list(text):
    words, word = [], b""
    for byte in (text or "").encode() + b" ":
        c = chr(byte)
        if byte >= 0x80 or (c.isascii() and c.isalnum()):
            word += c.lower().encode() if byte < 0x80 else bytes([byte])
        elif word:
            words.append(word)
            word = b""
    return words


def spots(text, anchors):
    """Signatures as word tuples; a text without any has one of its own kind."""
    words = word_list(text)
    out = set()
    for k, word in enumerate(words):
        chain = [w for w in words[k + 1 :] if w not in anchors][:2]
        if word in anchors and len(chain) == 2:
            out.add((word, *chain))
    if out:
        return out
    return {("whole", *words)} if words else {("bytes", text)} if text else set()


def anchor_words(texts, share=spotsigs.ANCHOR_SHARE):
    counts, total = {}, 0
    for text in texts:
        for w in word_list(text):
            counts[w] = counts.get(w, 0) + 1
            total += 1
    return {w for w, n in counts.items() if n >= share * total}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected_rows(pairs):
    """By (doc_id, text) of distinct documents in falling order of doc_id."""
    anchors = anchor_words([t for _, t in pairs])
    order = sorted(pairs, key=lambda p: -p[0])
    out = {}
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        own = spots(text, anchors)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out[doc_id] = (n, digest, jaccard(own, spots(edited, anchors)), jaccard(own, spots(after, anchors)))
    return out


def check(found, expected):
    assert {r["doc_id"] for r in found} == set(expected)
    for r in found:
        n, digest, edited, following = expected[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, digest)
        assert abs(r["near_edited"] - edited) < 1e-12 and abs(r["near_next"] - following) < 1e-12


def test_query_equals_brute_force(spark, small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    found = op11_fingerprints(spark, SMALL).collect()
    assert len(found) == len(rows)
    check(found, expected_rows(rows))
    by_text = {}
    for r, text in ((r, dict(rows)[r["doc_id"]]) for r in found):
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        signatures = {r["fingerprint"][k : k + 12] for k in range(0, len(r["fingerprint"]), 12)}
        assert len(signatures) * 12 == len(r["fingerprint"])
    assert np.mean([r["near_edited"] for r in found]) > 0.4 > np.mean([r["near_next"] for r in found])


def test_anchors_are_the_words_of_the_asked_share(spark, docs, monkeypatch):
    monkeypatch.setattr(spotsigs, "SUMMARY", 64)
    rnd = random.Random(5)
    texts = [" ".join(["the"] * 3 + ["Of"] * 2 + [f"w{rnd.randint(0, 2000)}" for _ in range(40)]) for _ in range(60)]
    found = common_words(docs(*texts, None, "").repartition(4), 1 / 40)
    wanted = anchor_words(texts, 1 / 40)
    assert wanted == {b"the", b"of"} and len(found) == 2
    assert len(common_words(docs(None, ""))) == 0


def test_odd_rows(spark, docs):
    texts = ["the cat sat on the mat", "The cat sat", None, "", "!?", "é" * 5, "the " * 40_000 + "end of it all"]
    pairs = [(k, t) for k, t in enumerate(texts)]
    check(compare_edited(docs(*pairs)).collect(), expected_rows(pairs))
    lone = compare_edited(docs((7, "a b c"))).collect()
    assert [(r["doc_id"], r["near_next"]) for r in lone] == [(7, 1.0)]
    assert lone[0]["edited_sha256"] == hashlib.sha256(b"a b a").hexdigest()
    assert compare_edited(docs((7, "x")).limit(0)).collect() == []
    rows = [(1, "one two", "k", 1), (1, "one two", "k", 1), (1, "other", "k", 2), (None, "last", "k", 3), (None, None, "k", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string, packed int")
    found = compare_edited(frame).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "1", "None", "None"]
    twins = [r for r in found if r["n_chars"] == 7]
    assert len(twins) == 2 and twins[0] == twins[1]


def test_likeness_is_pruned_by_size():
    a, b = np.arange(4, dtype=np.uint64), np.arange(8, dtype=np.uint64)
    assert likeness(a, b) == 0.5 and likeness(a, b, 0.6) == 0.0 and likeness(a[:0], b[:0]) == 1.0
    assert [spotsigs.length_partition(s, 80) for s in (1, 2, 3, 4, 5, 6, 7)] == [0, 1, 2, 3, 3, 4, 4]


def _components(pairs, percent):
    anchors = anchor_words([t for _, t in pairs])
    sets = {k: spots(t, anchors) for k, t in pairs}
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {k: top(k) for k in sets}


def test_components_equal_brute_force(spark, docs, small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    pairs = rows + [(1000 + k, t) for k, t in _chains()]
    found = {r["doc_id"]: r["component_id"] for r in spot_components(docs(*pairs)).collect()}
    assert found == _components(pairs, 80)
    found = spot_components(docs((None, "the a b"), (1, None), (1, ""))).collect()
    assert all(r["kept"] for r in found) and len(found) == 3


def _chains():
    """Texts that grow into each other, so that components are longer than one link."""
    rnd = random.Random(8)
    pairs = []
    for start in range(4):
        words = [f"x{start}y{rnd.randint(0, 500)}" for _ in range(120)]
        for step in range(12):
            place = rnd.randrange(len(words))
            words[place] = f"new{rnd.randint(0, 10**6)}"
            text = " ".join(w if k % 3 else f"the {w}" for k, w in enumerate(words))
            pairs.append((100 * start + step, text))
    return pairs
