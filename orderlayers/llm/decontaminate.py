"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words: the hash of the words at its 1s, whatever stands
at its 0s. Words are runs of ASCII letters, ASCII digits and anything beyond ASCII, lower-cased.
All seeds of all items are the test table. Each document's seeds are looked up in filters of
fixed size, made of the test table's hashes; those that may be in the table are joined to it on
their hash. Around each joined hit, document and item are compared word by word on the hit's
diagonal, so replaced words are tolerated and inserted ones end an overlap.

An item contaminates a document when some WINDOW consecutive words of the item, around a hit,
stand in the document with at least MATCHED of them equal. A shorter item is compared whole and
needs the same share, one of fewer than SHORT words all its words. Items of fewer than four
words name nothing: no seed fits in them.

Defined results: NULL and empty texts are clean and contaminate nothing; an item whose
``item_id`` is NULL still contaminates (it is listed as `null`). Repeated items and documents
give the same results for each of their rows; a NULL ``doc_id`` is a row like any other. Other
columns, whatever their names, pass through ``drop_contaminated`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import (
    ALNUM,
    bit_filter,
    drop_rows,
    in_filter,
    mix,
    stored,
    text_slices,
    word_bounds,
    word_hashes,
)

#: Fixed masks of weight four. Together they hit each run of twelve words of which every fourth
#: was replaced, and most others with three replaced.
MASKS = ("1111", "11011", "1010011", "1100101")
WINDOW, MATCHED, SHORT = 12, 9, 8
#: Bits of each of two filters, by the low and the high half of the hashes, whatever their number:
#: 1 MB each. Full filters cost time, not results.
FILTER_BITS = 23

_LONGEST = max(map(len, MASKS))


def seed_hashes(words: np.ndarray, mask_number: int) -> np.ndarray:
    """Hash of the mask at each place where it fits."""
    mask = MASKS[mask_number]
    places = len(words) - len(mask) + 1
    if places <= 0:
        return np.empty(0, np.uint64)
    total = np.full(places, mask_number + 1, np.uint64)
    for k, taken in enumerate(mask):
        if taken == "1":
            total = mix(total * np.uint64(31) + words[k : k + places])
    return total


def _lowered(frame: DataFrame, key: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return frame.select(
        F.col(key).cast("long").alias("id"),
        F.xxhash64(F.col(key), F.col("text")).alias("row_key"),
        F.lower(text).alias("text"),
    )


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            starts, ends, marks = word_bounds(data, offsets, ALNUM)
            words = word_hashes(data, starts, ends)
            ids = batch.column(0).slice(first, last - first).to_pylist()
            out = {"item_id": [], "seed": [], "place": [], "words": []}
            for row, item in enumerate(ids):
                own = words[marks[row] : marks[row + 1]]
                for m in range(len(MASKS)):
                    for place, seed in enumerate(seed_hashes(own, m)):
                        # The words that a window around this place can hold.
                        low = max(place - WINDOW + 1, 0)
                        high = min(place + _LONGEST + WINDOW, len(own))
                        whole = len(own) <= WINDOW
                        piece = own if whole else own[low:high]
                        out["item_id"].append(item)
                        out["seed"].append(int(seed.view(np.int64)))
                        out["place"].append(place if whole else place - low)
                        out["words"].append(piece.view(np.int64).tolist())
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [
                        ("item_id", pa.int64()),
                        ("seed", pa.int64()),
                        ("place", pa.int32()),
                        ("words", pa.list_(pa.int64())),
                    ]
                ),
            )


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """(item_id, seed, place, words) for all seeds of ``benchmark`` (item_id, text)."""
    return _lowered(benchmark, "item_id").mapInArrow(
        _item_batches, "item_id long, seed long, place int, words array<long>"
    )


def _hit_batches(bits):
    reach = WINDOW + _LONGEST

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low_filter, high_filter = bits.value
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                starts, ends, marks = word_bounds(data, offsets, ALNUM)
                words = word_hashes(data, starts, ends)
                row_of = np.repeat(np.arange(last - first), np.diff(marks))
                found, seeds = [], []
                for m, mask in enumerate(MASKS):
                    hashed = seed_hashes(words, m)
                    if not len(hashed):
                        continue
                    at = np.flatnonzero(in_filter(low_filter, hashed))
                    at = at[in_filter(high_filter, hashed[at] >> np.uint64(32))]
                    at = at[row_of[at] == row_of[at + len(mask) - 1]]
                    found.append(at)
                    seeds.append(hashed[at])
                if not found:
                    continue
                at, seeds = np.concatenate(found), np.concatenate(seeds)
                rows = row_of[at]
                low = np.maximum(at - reach, marks[rows])
                high = np.minimum(at + reach, marks[rows + 1])
                sizes = high - low
                ends_of = np.concatenate([[0], np.cumsum(sizes)])
                index = np.arange(ends_of[-1]) - np.repeat(ends_of[:-1] - low, sizes)
                take = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(seeds.view(np.int64)),
                        pa.array(at - marks[rows]),
                        pa.array((at - low).astype(np.int32)),
                        pa.ListArray.from_arrays(
                            pa.array(ends_of.astype(np.int32)), pa.array(words[index].view(np.int64))
                        ),
                    ],
                    ["doc_id", "row_key", "seed", "at", "within", "around"],
                )

    return work


def _check_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best window of each hit: matched words, and where it begins in the document."""
    for batch in batches:
        around, words = batch.column("around").to_pylist(), batch.column("words").to_pylist()
        keep, matched, start, length = [], [], [], []
        for row, (within, place, at) in enumerate(
            zip(
                batch.column("within").to_pylist(),
                batch.column("place").to_pylist(),
                batch.column("at").to_pylist(),
                strict=True,
            )
        ):
            item, text = np.array(words[row]), np.array(around[row])
            equal = np.zeros(len(item), np.int64)
            shift = within - place  # item word k stands at text word k + shift
            low, high = max(0, -shift), min(len(item), len(text) - shift)
            equal[low:high] = item[low:high] == text[low + shift : high + shift]
            size = min(len(item), WINDOW)
            sums = np.convolve(equal, np.ones(size, np.int64), "valid")
            best = int(sums.argmax())
            least = size if size < SHORT else -(-MATCHED * size // WINDOW)
            if sums[best] >= least:
                keep.append(row)
                matched.append(int(sums[best]))
                start.append(at - place + best)
                length.append(size)
        take = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n).take(take) for n in ("doc_id", "row_key", "item_id")),
                pa.array(matched, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int32()),
            ],
            ["doc_id", "row_key", "item_id", "matched", "start", "length"],
        )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row_key, item_id, matched, first_word, last_word) for each document and item.

    ``matched`` is the best window's number of equal words; the words from ``first_word`` to
    ``last_word`` (from 0) take in all windows of the item. ``row_key`` is xxhash64(doc_id,
    text), the row whatever its id.
    """
    seeds = stored(item_seeds(benchmark), "decontaminate-seeds")
    high = seeds.selectExpr("shiftrightunsigned(seed, 32) AS seed")
    filters = [bit_filter(half, "seed", FILTER_BITS) for half in (seeds, high)]
    bits = docs.sparkSession.sparkContext.broadcast(filters)
    hits = stored(
        _lowered(docs, "doc_id").mapInArrow(
            _hit_batches(bits),
            "doc_id long, row_key long, seed long, at long, within int, around array<long>",
        ),
        "decontaminate-hits",
    )
    checked = hits.join(seeds, "seed").mapInArrow(
        _check_batches,
        "doc_id long, row_key long, item_id long, matched int, start long, length int",
    )
    return checked.groupBy("doc_id", "row_key", "item_id").agg(
        F.max("matched").alias("matched"),
        F.min("start").alias("first_word"),
        F.max(F.col("start") + F.col("length") - 1).alias("last_word"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each contaminated document: doc_id, n_items, items, matched, first and last word."""
    named = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    return (
        overlaps(docs, benchmark)
        .groupBy("doc_id", "row_key")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.array_join(F.array_sort(F.collect_set(named)), ",").alias("items"),
            F.max("matched").alias("matched"),
            F.min("first_word").alias("first_word"),
            F.max("last_word").alias("last_word"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns as they were."""
    found = stored(overlaps(docs, benchmark).select("row_key").distinct(), "decontaminate-found")
    return drop_rows(docs, found, "row_key")
