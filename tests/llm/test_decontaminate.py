from __future__ import annotations

import random

import pytest

from orderlayers.llm.decontaminate import MASKS, contaminated, drop_contaminated


@pytest.fixture
def benchmark(spark):
    r = random.Random(2)
    items = [" ".join(f"b{r.randrange(500)}" for _ in range(n)) for n in (40, 25, 12, 9, 5)]
    rows = [*enumerate(items), (5, None), (6, ""), (7, "x y z"), (None, " ".join(f"n{k}" for k in range(20)))]
    return spark.createDataFrame(rows, "item_id long, text string")


def noise(n, seed):
    r = random.Random(seed)
    return " ".join(f"b{r.randrange(500)}" for _ in range(n))


def test_whole_items_and_replaced_words_are_found_and_noise_is_not(docs, benchmark):
    items = {x["item_id"]: x["text"] for x in benchmark.collect()}
    rows = [(100 + k, f"{noise(50, 70 + k)} {items[k]} {noise(50, 90)}") for k in range(5)]
    for k in (0, 1):
        words = items[k].upper().split()
        for at in range(3, len(words), 5):
            words[at] = "zork"
        rows.append((200 + k, "Start. " + ", ".join(words)))
    rows += [(300 + k, noise(400, 50 + k)) for k in range(20)]
    rows += [(400, None), (401, ""), (402, items[None]), (None, items[0]), (None, items[0])]
    found = {(x["doc_id"], x["items"]) for x in contaminated(docs(*rows), benchmark).collect()}
    assert found == {
        (100, "0"), (101, "1"), (102, "2"), (103, "3"), (104, "4"), (200, "0"), (201, "1"), (402, "null"), (None, "0"),
    }
    kept = drop_contaminated(docs(*rows), benchmark)
    assert kept.columns == docs("x").columns
    assert sorted(x["doc_id"] for x in kept.collect()) == [*range(300, 320), 400, 401]


def test_half_an_item_is_found_but_few_words_are_not(docs, benchmark):
    words = benchmark.filter("item_id = 0").first()["text"].split()
    frame = docs(" ".join(words[10:24]), " ".join(words[5:13]))
    assert [x["doc_id"] for x in contaminated(frame, benchmark).collect()] == [0]


def test_masks_find_runs_with_every_fourth_word_replaced():
    for shift in range(4):
        equal = [(k + shift) % 4 != 3 for k in range(12)]
        assert any(
            all(equal[at + k] for k, c in enumerate(mask) if c == "1")
            for mask in MASKS
            for at in range(12 - len(mask) + 1)
        )


def test_empty_tables(docs, benchmark, spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert contaminated(none, benchmark).count() == 0
    assert drop_contaminated(docs("a b"), benchmark.limit(0)).count() == 1
