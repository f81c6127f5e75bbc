from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from orderlayers.llm.prefix_tokens import (
    LONGEST_REMEMBERED,
    Pieces,
    PrefixCounter,
    budget_answers,
    characters_within,
    prefix_counts,
    prefix_store,
    token_counts,
    tokens_of_first,
)

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    r = random.Random(3)
    texts = ["", " ", "  a", "a  b ", "▁a ▁▁", "<s>x</s>", "x<0x41>", "\x00a", "a\nb\n\n c", "é日本😀\U0010ffff", "2². x²y", "a" * 300]
    ranges = [(32, 127), (10, 11), (0xA0, 0x250), (0x250, 0x3000), (0x4E00, 0x5000)]
    return texts + ["".join(chr(r.randrange(*r.choice(ranges))) for _ in range(80)) for _ in range(40)]


def test_every_prefix_equals_the_library(library, small_docs):
    with open(PATH, "rb") as file:
        counter = PrefixCounter(Pieces(file.read()))
    for text in [*odd_texts(), *(x["text"][:200] for x in small_docs.limit(10).collect())]:
        expected = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert counter.every(text).tolist() == expected
        assert counter.total(text) == expected[-1]


def test_whole_texts(docs, small_docs, library):
    frame = docs(*((10**6 + k, t) for k, t in enumerate([None, *odd_texts()]))).select("doc_id", "text").union(
        small_docs.select("doc_id", "text")
    )
    texts = {x["doc_id"]: x["text"] or "" for x in frame.collect()}
    for row in token_counts(frame, PATH).collect():
        text = texts[row["doc_id"]]
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), len(library.encode(text)))


def test_budget_questions_need_no_encoding(docs, library):
    text = "Some words, and the others of them."
    counts = prefix_counts(docs(text, None), PATH)
    row = counts.select(
        "doc_id",
        tokens_of_first(F.lit(10)).alias("first"),
        characters_within(F.lit(4)).alias("fits"),
        characters_within(F.lit(0)).alias("none"),
    ).orderBy("doc_id").collect()
    sizes = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
    assert row[0]["first"] == sizes[10]
    assert row[0]["fits"] == max(k for k, n in enumerate(sizes) if n <= 4)
    assert (row[0]["none"], row[1]["first"], row[1]["fits"]) == (0, 0, 0)


def test_store_answers_equal_encodings(docs, library):
    texts = [None, *odd_texts(), "word " * 400, "x" * 5000, "\u00e9" * 3000]
    frame = docs(*((k, t) for k, t in enumerate(texts)))
    store = prefix_store(frame, PATH)
    for budget in (0, 1, 7, 300):
        for row in budget_answers(store, budget).collect():
            text = texts[row["doc_id"]] or ""
            sizes = [len(library.encode(text[:k])) for k in range(min(len(text), 1000) + 1)]
            assert row["n_chars"] == len(text) and row["n_tokens"] == len(library.encode(text))
            if len(text) <= 1000:
                assert row["fitting_chars"] == max(k for k, n in enumerate(sizes) if n <= budget)
            elif row["fitting_chars"] < len(text):
                cut = row["fitting_chars"]
                assert len(library.encode(text[:cut])) <= budget < len(library.encode(text[: cut + 1]))


def test_empty_tables_repeated_rows_null_ids_and_other_columns(spark, docs, library):
    text = "a text that comes twice"
    frame = docs((1, text), (1, text), (None, text), (2, "a" * 300_000 + " b")).withColumn("steps", F.lit("x")).withColumn("n_tokens", F.lit(0))
    rows = budget_answers(prefix_store(frame, PATH), 4096).collect()
    size = len(library.encode(text))
    assert sorted((x["doc_id"] or 0, x["n_tokens"]) for x in rows)[:3] == [(0, size), (1, size), (1, size)]
    long = next(x for x in rows if x["doc_id"] == 2)
    assert long["n_tokens"] == len(library.encode("a" * 300_000 + " b")) > 4096
    cut = long["fitting_chars"]
    assert len(library.encode("a" * cut)) <= 4096 < len(library.encode("a" * (cut + 1)))
    assert prefix_store(frame.limit(0), PATH).count() == 0
    assert budget_answers(prefix_store(frame.limit(0), PATH), 5).count() == 0


def test_long_units_are_not_remembered():
    with open(PATH, "rb") as file:
        counter = PrefixCounter(Pieces(file.read()))
    counter.steps("short " + "y" * 1000)
    assert max(map(len, counter.known)) <= LONGEST_REMEMBERED and len(counter.known) == 1  # the white space is part of the long one
