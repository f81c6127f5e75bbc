from __future__ import annotations

import numpy as np
import pyarrow as pa

from orderlayers.llm.common import ALNUM, SPACED, gram_hashes, slices, text_column, word_bounds, word_hashes
from orderlayers.llm.components import connected_components


def words(texts, member):
    data, offsets = text_column(pa.array(texts))
    starts, ends, marks = word_bounds(data, offsets, member)
    hashed = word_hashes(data, starts, ends)
    cut = [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    return cut, hashed, marks


def test_words_do_not_cross_rows_and_hash_alike_wherever_they_stand():
    cut, hashed, marks = words(["Ab cd", "", None, "ef", "gh ab"], SPACED)
    assert cut == [b"Ab", b"cd", b"ef", b"gh", b"ab"]
    assert marks.tolist() == [0, 2, 2, 2, 3, 5]
    assert hashed[0] == hashed[4]
    assert len(set(hashed.tolist())) == 4


def test_alnum_words_keep_bytes_beyond_ascii():
    assert words(["Él,x1-y"], ALNUM)[0] == ["Él".encode(), b"x1", b"y"]


def test_grams_stay_in_their_row():
    _, hashed, marks = words(["a b c", "d", "e f"], SPACED)
    grams, first = gram_hashes(hashed, marks, 2)
    assert first.tolist() == [0, 2, 2, 3]
    assert len(set(grams.tolist())) == 3


def test_slices_cover_all_rows_and_isolate_long_ones():
    offsets = np.array([0, 3, 3, 50, 52, 60])
    assert list(slices(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]


def test_components_of_paths_stars_and_repeats(spark):
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(1000, k) for k in range(1001, 1040)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (7, 6), (6, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert found == {**{k: 100 for k in range(100, 141)}, **{k: 1000 for k in range(1000, 1040)}, 6: 6, 7: 6}


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
