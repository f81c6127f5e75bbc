"""Token alignment against a brute force over the two libraries' own tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderlayers.llm.bpe import byte_letters
from orderlayers.llm.queries import op13_token_alignment
from orderlayers.llm.token_alignment import Aligned, is_settled

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def spans():
    """(ids, byte ranges) of A and of B for a text, or None where they don't spell it."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    letters = {letter: byte for byte, letter in enumerate(byte_letters())}
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def of_piece(k):
        piece = second.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(k) else piece.replace("▁", " ").encode()

    def ranged(ids, parts):
        out, at = [], 0
        for k, part in zip(ids, parts):
            out.append((k, at, at + len(part)))
            at += len(part)
        return out

    def work(text):
        if not text:
            return None
        whole = (" " + text).encode()
        ids = first.encode(" " + text, add_special_tokens=False).ids
        a = ranged(ids, [bytes(letters[c] for c in first.id_to_token(k)) for k in ids])
        ids = second.encode(text)
        parts = [of_piece(k) for k in ids]
        return (a, ranged(ids, parts)) if b"".join(parts) == whole else None

    return work


def brute_force(spans, texts):
    linked, out = Counter(), []
    for text in texts:
        found = spans(text)
        if found is None:
            out.append(None)
            continue
        a, b = found
        links = [(x[0], y[0]) for x in a for y in b if x[2] == y[2]] if len(a) < 60 else None
        if links is None:
            end = {y[2]: y[0] for y in b}
            links = [(x[0], end[x[2]]) for x in a if x[2] in end]
        groups, ends = [], sorted({x[2] for x in a} & {y[2] for y in b})
        low = 0
        for high in ends:
            sides = [",".join(str(t[0]) for t in side if low < t[2] <= high) for side in (a, b)] if len(a) < 60 else None
            groups.append("|".join(sides) if sides else None)
            low = high
        linked.update(links)
        out.append((a, b, links, groups))
    most = Counter()
    for (_, b), n in linked.items():
        most[b] = max(most[b], n)
    rows = []
    for found in out:
        if found is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = found
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        best = sum(linked[p] == most[p[1]] for p in links)
        rows.append((len(a), len(b), len(groups), len(links), best, sum(linked[p] for p in links), digest))
    return rows


def agree(found, expected):
    assert len(found) == len(expected)
    for row, own in zip(found, expected):
        got = tuple(row[c] for c in COLUMNS)
        assert got[:-1] == own[:-1] and (own[-1] is None or got[-1] == own[-1])


TEXTS = [
    "Hello world, don't stop", "hello  hello\n\nworld ", "<|endoftext|> </s> <s>", "naïve café 你好 🙂🚀", "a▁b", "", None,
    " ", "\t\x00x", "Hello world, don't stop", "٣٤ ½² \x85\x1c", "x" * 200, "한글 ᠎ é",
]


@pytest.mark.parametrize("frequent", [1, 8, 1 << 19])
def test_equals_brute_force(spark, docs, spans, frequent):
    frame = docs(*[(k, t) for k, t in enumerate(TEXTS)])
    found = Aligned(frame, A, B, frequent).digests(frame).orderBy("doc_id").collect()
    agree(found, brute_force(spans, TEXTS))


def test_query_equals_brute_force_on_whole_table(spark, small_docs, spans):
    rows = sorted(small_docs.select("doc_id", "text").collect())
    found = op13_token_alignment(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    agree(found, brute_force(spans, [r["text"] for r in rows]))


def test_groups_cut_both_lists(spark, docs, spans):
    frame = docs(*TEXTS)
    for row, text in zip(Aligned(frame, A, B).groups(frame).orderBy("doc_id").collect(), TEXTS):
        found = spans(text)
        if found is None:
            assert row["a_ids"] == row["b_ids"] == row["a_last"] == row["b_last"] == []
            continue
        a, b = found
        assert [x[0] for x in a] == row["a_ids"] and [x[0] for x in b] == row["b_ids"]
        assert [a[k][2] for k in row["a_last"]] == [b[k][2] for k in row["b_last"]] == sorted({x[2] for x in a} & {x[2] for x in b})


def test_odd_rows(spark, spans):
    long = "lorem ipsum " * 30_000
    rows = [(None, "one two", 1, "r"), (1, "one two", 2, "r"), (1, "one two", 2, "r"), (2, long, 3, "r")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, links int, row string")
    found = Aligned(frame, A, B).digests(frame).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"]) for r in found if r["doc_id"] != 2) == [(0, 2), (1, 2), (1, 2)]
    expected = brute_force(spans, [r[1] for r in rows])
    by_id = {r["doc_id"]: tuple(r[c] for c in COLUMNS[:-1]) for r in found}
    assert by_id[2] == expected[3][:-1] and by_id[None] == by_id[1] == expected[0][:-1]
    empty = frame.limit(0)
    assert Aligned(empty, A, B).digests(empty).collect() == []


def test_settled_characters():
    assert is_settled("a") and is_settled("\n") and is_settled("你")
    assert not is_settled("\x85") and not is_settled("᠎") and not is_settled("\x1c")
