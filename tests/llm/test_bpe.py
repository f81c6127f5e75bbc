from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlayers.llm.bpe import BpeCodec, compile_lexicon, lookup, map_lexicon, save_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    r = random.Random(5)
    texts = [
        None, "", "   ", "aaaa aaaaa aaa", "Hello  World's <|endoftext|>x é 日本 😀 <|startoftext|>'s'student",
        "ΑΣ ΟΔΟΣ İI ạ̇ éx क़", "\x1c\x1d a\x85b c d", "zqx" * 400, "don't I'LL we've '' 'sx 1234 ½ ²",
    ]
    ranges = [(32, 127), (0xA0, 0x250), (0x250, 0x3000), (0x1F300, 0x1F600), (0x1C80, 0x1C90), (0xA7C0, 0xA7E0)]
    return texts + ["".join(chr(r.randrange(*r.choice(ranges))) for _ in range(150)) for _ in range(30)]


def test_ids_and_decoded_text_equal_the_library(docs, small_docs, library):
    frame = docs(*((10**6 + k, t) for k, t in enumerate(odd_texts()))).select("doc_id", "text").union(
        small_docs.select("doc_id", "text")
    )
    texts = {x["doc_id"]: x["text"] or "" for x in frame.collect()}
    rows = BpeCodec(frame, PATH, frequent=500).digests(frame).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_decode_of_stored_ids(docs, library):
    frame = docs("Some text, again.", None)
    codec = BpeCodec(frame, PATH)
    ids = codec.encode(frame).select("doc_id", "ids", "n_tokens")
    rows = codec.decode(ids).orderBy("doc_id").collect()
    assert [x["decoded"] for x in rows] == [library.decode(x["ids"], skip_special_tokens=False) for x in rows]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert BpeCodec(none, PATH).digests(none).count() == 0


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = sorted(w.encode() for w in ("tap", "taps", "top", "tops", "é", "stop", "stops"))
    lexicon = compile_lexicon(words, [np.array([k, k]) for k in range(len(words))])
    # One final state with and one without an s behind it, shared by all words.
    assert len(lexicon["final"]) < sum(map(len, words))
    assert int(lexicon["final"].sum()) == 2
    save_lexicon(lexicon, f"{tmp_path}/x.bin")
    mapped = map_lexicon(f"{tmp_path}/x.bin")
    assert lookup(mapped, [*words, b"to", b"topss", b"x"]).tolist() == [*range(len(words)), -1, -1, -1]
