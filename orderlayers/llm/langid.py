"""Language ID: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Subwords are the 2- to 4-byte windows of the lower-cased text that lie within one word and the
white space around it, hashed into buckets. A document is the average of its subwords' vectors;
a softmax over languages reads the average. Vectors and softmax are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled documents. A further part
of the sample, never trained on, sets the temperature that makes the softmax's probabilities
honest; a prediction whose calibrated probability is below the threshold is rejected.

The average is linear, so for prediction each bucket's vector is folded with the softmax into
one score per language: a document's scores are the mean of its subwords' rows of a small table.

Defined results: NULL text, or text without a letter, is `und` with score 0 and is rejected;
so is everything where no labelled document exists. Whole texts are read. Rows are predicted
one by one: repeated rows get equal predictions, a NULL ``doc_id`` is an id like any other.
``lang``, ``source`` and ``doc_id`` are no inputs of a prediction. Ties go to the language that
sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import ALNUM, crc_of_id, text_slices

#: At most about this many labelled documents of one language are learned from (the bounded
#: sample): documents are taken by a hash of their id whose share is set by the language's count.
SAMPLE_PER_LANGUAGE = 400
#: The languages with most labelled documents that are learned at all.
LANGUAGES = 200
BUCKET_BITS, DIMENSIONS, EPOCHS = 15, 16, 12
BUCKETS = 1 << BUCKET_BITS
LENGTHS = (2, 3, 4)
#: An odd factor for each length of subword.
_FACTORS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}
#: A prediction is rejected when its calibrated probability is below this.
ACCEPT = 0.4

_LETTER = ALNUM.copy()
_LETTER[0x30:0x3A] = False
_FOLDED = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint8)
_FOLDED[0x41:0x5B] += 32


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the buckets of the subwords of all rows and where each row's begin.

    A window may begin or end with one separator, but holds none inside, and lies in one row.
    """
    size = len(data)
    folded = _FOLDED[data]
    letter = folded != 0x20
    code = folded.astype(np.uint32)
    inner = np.ones(size, bool)
    for length in range(2, LENGTHS[-1] + 1):
        here = max(size - length + 1, 0)
        code = (code[:here] << np.uint32(8)) | folded[length - 1 :][:here]
        inner = inner[:here]
        if length > 2:  # the byte before the last is inside now
            inner = inner & letter[length - 2 : length - 2 + here]
        fits = inner.copy() if length > 2 else letter[:here] | letter[1:][:here]
        for k in range(1, length):  # windows that reach into the next row
            crossing = offsets[1:-1] - k
            fits[crossing[(crossing >= 0) & (crossing < here)]] = False
        at = np.flatnonzero(fits)
        hashed = code[at] * np.uint32(_FACTORS[length])
        yield (hashed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), np.searchsorted(at, offsets)


@dataclass
class LanguageModel:
    languages: list[str]
    columns: np.ndarray  # (languages, BUCKETS) float32: a subword's scores
    bias: np.ndarray
    temperature: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, kinds = len(offsets) - 1, len(self.languages)
        totals, counts = np.zeros((rows, kinds)), np.zeros(rows)
        for buckets, marks in subwords(data, offsets):
            sizes = np.diff(marks)
            counts += sizes
            some = np.flatnonzero(sizes)
            if len(some):
                for k in range(kinds):
                    part = np.add.reduceat(self.columns[k][buckets], marks[some], dtype=np.float64)
                    totals[some, k] += part
        return totals / np.maximum(counts, 1)[:, None] + self.bias

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return _softmax(scores / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            found = [
                np.repeat(np.arange(last - first), np.diff(marks)) * BUCKETS + buckets
                for buckets, marks in subwords(data, offsets)
            ]
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            rows = keys // BUCKETS
            sizes = np.bincount(rows, weights=counts, minlength=last - first)
            marks = np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32)
            marks = pa.array(marks)
            ids = pa.array((keys % BUCKETS).astype(np.int32))
            weights = pa.array((counts / sizes[rows]).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(first, last - first),
                    batch.column(2).slice(first, last - first),
                    pa.ListArray.from_arrays(marks, ids),
                    pa.ListArray.from_arrays(marks, weights),
                ],
                ["lang", "place", "ids", "weights"],
            )


def train_language_model(labelled: DataFrame, seed: int = 7) -> LanguageModel | None:
    """Fit on ``labelled`` (doc_id, text, lang); None where it holds no usable row.

    The driver learns the rows per language, and then gets the subword counts of the sampled
    documents alone: at most LANGUAGES * SAMPLE_PER_LANGUAGE or so, each with at most BUCKETS
    numbers, whatever the size of the table.
    """
    known = labelled.filter(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, SAMPLE_PER_LANGUAGE / row["count"]))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30))
    sample = known.select("text", "lang", place.alias("place")).filter(F.col("place") < share * (1 << 30))
    rows = sample.mapInArrow(
        _feature_batches, "lang string, place long, ids array<int>, weights array<float>"
    ).toArrow()
    # Row order depends on scheduling; training must not.
    order = np.lexsort((np.array(rows["ids"].combine_chunks().value_lengths()), rows["place"].to_numpy()))
    rows = rows.take(pa.array(order)).combine_chunks()
    languages = sorted({row["lang"] for row in counts})
    target = np.array([languages.index(x) for x in rows["lang"].to_pylist()], np.int64)
    ids = rows["ids"].combine_chunks()
    marks = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
    flat = ids.flatten().to_numpy()
    weights = rows["weights"].combine_chunks().flatten().to_numpy()
    return _fit(languages, target, marks, flat, weights, seed)


def _fit(languages, target, marks, flat, weights, seed) -> LanguageModel:
    """Stochastic gradient descent over single documents; every fifth one is for calibration."""
    generator = np.random.default_rng(seed)
    vectors = generator.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    softmax = generator.normal(0, 0.1, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    rows = np.arange(len(target))
    held = rows % 5 == 4 if len(rows) >= 50 else np.zeros(len(rows), bool)
    # Languages weigh alike, however many documents of each there are.
    per_language = np.bincount(target, minlength=len(languages))
    weight = len(target) / (np.maximum(per_language, 1) * max((per_language > 0).sum(), 1))
    for epoch in range(EPOCHS):
        rate = 2.0 * (1 - epoch / EPOCHS)
        for row in generator.permutation(rows[~held]):
            at = flat[marks[row] : marks[row + 1]]
            share = weights[marks[row] : marks[row + 1]]
            mean = share @ vectors[at]
            scores = mean @ softmax + bias
            chance = np.exp(scores - scores.max())
            error = chance / chance.sum()
            error[target[row]] -= 1
            error *= weight[target[row]] * rate
            back = softmax @ error
            softmax -= 0.1 * np.outer(mean, error)
            bias -= 0.01 * error
            # Scaled up, since a subword's share of its document is small.
            vectors[at] -= np.outer(np.minimum(share * 20, 1.0), back)
    model = LanguageModel(languages, np.ascontiguousarray((vectors @ softmax).T.astype(np.float32)), bias, 1.0)
    proof = rows[held] if held.any() else rows
    scores = np.array(
        [
            model.columns[:, flat[marks[r] : marks[r + 1]]] @ weights[marks[r] : marks[r + 1]] + bias
            for r in proof
        ]
    )
    model.temperature = _temperature(scores, target[proof])
    return model


def _temperature(scores: np.ndarray, target: np.ndarray) -> float:
    """The temperature of least log loss; one imagined miss keeps it from going to zero."""
    best, least = 1.0, np.inf
    for value in np.geomspace(0.05, 20, 61):
        chance = _softmax(scores / value)
        loss = -np.log(np.maximum(chance[np.arange(len(target)), target], 1e-12)).sum()
        loss -= np.log(np.maximum(1 - chance.max(axis=1).mean(), 1e-12))
        if loss < least:
            best, least = float(value), loss
    return best


def _predict_batches(model: LanguageModel | None):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            for first, last, data, offsets in text_slices(batch):
                rows = last - first
                if model is None:
                    predicted, score = ["und"] * rows, np.zeros(rows)
                else:
                    chance = model.probabilities(model.scores(data, offsets))
                    best = chance.argmax(axis=1)
                    predicted = pa.array(model.languages).take(pa.array(best))
                    score = chance[np.arange(rows), best]
                kept = [batch.column(batch.schema.get_field_index(n)).slice(first, rows) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, predicted if isinstance(predicted, pa.Array) else pa.array(predicted), pa.array(score)],
                    [*names, "guess", "chance"],
                )

    return work


def predict_languages(docs: DataFrame, model: LanguageModel | None, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of ``docs`` (doc_id, text)."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        F.col("text").cast("string").alias("text"),
    )
    guessed = texts.mapInArrow(
        _predict_batches(model), "doc_id long, lettered boolean, guess string, chance double"
    )
    return guessed.select(
        "doc_id",
        F.when(F.col("lettered"), F.col("guess")).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.col("chance")).otherwise(0.0).alias("score"),
        (~F.col("lettered") | (F.col("chance") < accept)).alias("rejected"),
    )


def keep_known_languages(docs: DataFrame, model: LanguageModel | None, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose language the model accepts, all columns as they were.

    Where nothing could be learned, for lack of any labelled document, nothing is rejected.
    """
    if model is None:
        return docs
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    names = docs.columns
    guessed = docs.filter(lettered).mapInArrow(_keep_batches(model, accept), docs.schema)
    return guessed.select(*[F.col(f"`{n}`") for n in names])


def _keep_batches(model: LanguageModel, accept: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for first, last, data, offsets in text_slices(batch):
                keep[first:last] = model.probabilities(model.scores(data, offsets)).max(axis=1) >= accept
            yield batch.filter(pa.array(keep))

    return work


def held_out(column: str = "doc_id") -> F.Column:
    """The documents that op2 never learns from."""
    return F.pmod(crc_of_id(column), F.lit(4)) == 2
