"""Quality by ordinal cumulative-link regression on graded ratings.

The ratings grade a document 0 (toxic), 1 (poor) or 2 (good). One set of hashed-text weights is
shared by all grades, and ordered thresholds cut its score: P(grade > k) is the logistic function
of score - threshold k. So each document gets an expected grade and a tail probability for every
grade, and selection is a bound on a tail probability.

Features are the distinct words, the distinct runs of signs, and classes of a few shares (signs,
capitals, digits, repeated words), each by its 64-bit hash. The weights of features that enough
rated documents share are a sorted table of bounded size; a feature that is not in it weighs 0,
so no two features share a weight by chance. A document counts each feature once, whatever its
length, which keeps one toxic word in a long text visible.

Defined results: NULL and empty texts have no words and are scored by what is left, their shares.
Ratings without a document, or with a NULL rating, teach nothing. A document rated several times
teaches each of its grades once. Without any usable rating all scores are NULL and every document is
kept. Repeated rows get equal scores, a NULL ``doc_id`` is scored like any other, other columns
are not read. Whole texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import ALNUM, byte_table, id_and_text, mix, text_slices, word_bounds, word_hashes

GRADES = 3
#: At most about this many rated documents of each grade are learned from (the bounded sample),
#: taken by a hash of their id whose share is set by the grade's count.
SAMPLE_PER_GRADE = 5000
#: Features kept, and how many documents of the sample must share one.
FEATURES, LEAST_DOCUMENTS = 1 << 16, 8
STEPS = 150
#: Inverse variance of the weights' prior: the fewer documents, the closer weights stay to 0.
PRIOR = 2.0
#: Documents with at least this probability of the best grade are kept.
ACCEPT = 0.5

_SIGNS = byte_table(lambda b: 0x20 < b < 0x7F and not chr(b).isalnum())
_UPPER = byte_table(lambda b: 0x41 <= b <= 0x5A)
_DIGIT = byte_table(lambda b: 0x30 <= b <= 0x39)
#: Upper ends of the classes of a share.
_CLASSES = np.array([0.0, 0.005, 0.01, 0.02, 0.04, 0.08, 0.16, 0.32, 0.64])


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every distinct feature of each row, and its row, ordered by row."""
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    hashes, owners = [], []
    row_of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    for kind, member in enumerate((ALNUM, _SIGNS)):
        starts, ends, marks = word_bounds(data, offsets, member)
        hashed = mix(word_hashes(data, starts, ends) + np.uint64(kind))
        owner = np.repeat(np.arange(rows), np.diff(marks))
        order = np.lexsort((hashed, owner))
        hashed, owner = hashed[order], owner[order]
        fresh = np.ones(len(hashed), bool)
        fresh[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
        hashes.append(hashed[fresh])
        owners.append(owner[fresh])
        if kind == 0:
            distinct = np.bincount(owner[fresh], minlength=rows)
            repeated = 1 - distinct / np.maximum(np.diff(marks), 1)
    shares = [np.bincount(row_of_byte[m[data]], minlength=rows) / size for m in (_SIGNS, _UPPER, _DIGIT)]
    for kind, share in enumerate([*shares, repeated]):
        level = np.searchsorted(_CLASSES, share)
        hashes.append(mix(np.uint64(1000 + 100 * kind) + level.astype(np.uint64)))
        owners.append(np.arange(rows))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashes)[order], owner[order]


@dataclass
class GradeModel:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        hashed, owner = _features(data, offsets)
        at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        weight = np.where(self.hashes[at] == hashed, self.weights[at], 0.0)
        return np.bincount(owner, weights=weight, minlength=len(offsets) - 1)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, by row."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grade_of() -> F.Column:
    """The grade of a row of ratings (quality 0 or 1, toxic 0 or 1); NULL where one is missing."""
    return F.when(F.col("toxic") == 1, 0).when((F.col("toxic") == 0) & F.col("quality").isNotNull(), 1 + F.col("quality").cast("int"))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            hashed, owner = _features(data, offsets)
            marks = np.searchsorted(owner, np.arange(last - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(first, last - first),
                    batch.column(2).slice(first, last - first),
                    pa.ListArray.from_arrays(pa.array(marks), pa.array(hashed.view(np.int64))),
                ],
                ["grade", "place", "hashes"],
            )


def train_grade_model(docs: DataFrame, labels: DataFrame, seed: int = 11) -> GradeModel | None:
    """Fit on the documents that ``labels`` (doc_id, quality, toxic) rate; None without any.

    The sample, about GRADES * SAMPLE_PER_GRADE ids, is broadcast, and the driver gets the features
    of its documents.
    """
    rated = labels.select(F.col("doc_id").cast("long").alias("rated_id"), grade_of().alias("grade")).filter(
        F.col("rated_id").isNotNull() & F.col("grade").between(0, GRADES - 1)
    ).distinct()
    counts = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for grade, count in sorted(counts.items()):
        share = F.when(F.col("grade") == grade, F.lit(min(1.0, SAMPLE_PER_GRADE / count))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("rated_id"), F.lit(seed)), F.lit(1 << 30))
    sample = rated.withColumn("place", place).filter(F.col("place") < share * (1 << 30))
    texts = id_and_text(docs)
    rows = (
        texts.join(F.broadcast(sample), texts.doc_id == sample.rated_id)
        .select("text", "grade", "place")
        .mapInArrow(_feature_batches, "grade int, place long, hashes array<long>")
        .toArrow()
    )
    if not rows.num_rows:
        return None
    lists = rows["hashes"].combine_chunks()
    # Row order depends on scheduling; training must not.
    order = np.lexsort((lists.value_lengths().to_numpy(), rows["grade"].to_numpy(), rows["place"].to_numpy()))
    rows = rows.take(pa.array(order))
    lists = rows["hashes"].combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    return _fit(
        rows["grade"].to_numpy().astype(np.int64),
        np.repeat(np.arange(len(sizes)), sizes),
        lists.flatten().to_numpy().view(np.uint64),
        np.array([counts.get(k, 0) for k in range(GRADES)], float),
    )


def _fit(grade: np.ndarray, owner: np.ndarray, hashed: np.ndarray, counts: np.ndarray) -> GradeModel:
    """Least cumulative-link log loss.

    Sampled grades weigh what all ratings of the grade weigh, so probabilities fit all ratings.
    """
    kinds, inverse, documents = np.unique(hashed, return_inverse=True, return_counts=True)
    common = np.flatnonzero(documents >= min(LEAST_DOCUMENTS, max(1, len(grade) // 4)))
    common = np.sort(common[np.argsort(-documents[common], kind="stable")[:FEATURES]])
    number = np.full(len(kinds), -1)
    number[common] = np.arange(len(common))
    feature = number[inverse]
    owner, feature = owner[feature >= 0], feature[feature >= 0]
    importance = (counts / np.bincount(grade, minlength=GRADES).clip(1))[grade]
    importance /= importance.sum()
    rows = np.arange(len(grade))

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        """Loss and its slope by weights, first threshold and log of the gap to the second."""
        weights, low_cut, gap = at[:-2], at[-2], np.exp(at[-1])
        score = np.bincount(owner, weights=weights[feature], minlength=len(grade))
        below = _logistic(np.stack([low_cut - score, low_cut + gap - score], axis=1))
        low = np.where(grade == 0, 0.0, below[rows, np.maximum(grade - 1, 0)])
        high = np.where(grade == GRADES - 1, 1.0, below[rows, np.minimum(grade, GRADES - 2)])
        chance = np.maximum(high - low, 1e-12)
        by_high, by_low = importance * high * (1 - high) / chance, importance * low * (1 - low) / chance
        by_weight = np.bincount(feature, weights=(by_high - by_low)[owner], minlength=len(weights))
        by_cut = [by_low[grade == k + 1].sum() - by_high[grade == k].sum() for k in range(GRADES - 1)]
        ridge = PRIOR / len(grade)
        value = -(importance * np.log(chance)).sum() + ridge / 2 * weights @ weights
        return value, np.concatenate([by_weight + ridge * weights, [sum(by_cut), by_cut[1] * gap]])

    best = _minimum(loss, np.append(np.zeros(len(common)), [-1.0, 0.0]))
    return GradeModel(kinds[common], best[:-2], np.array([best[-2], best[-2] + np.exp(best[-1])]))


def _minimum(loss, at: np.ndarray, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking."""
    value, slope = loss(at)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        direction, shares = -slope, []
        for move, bend, scale in reversed(moves):
            shares.append(scale * (move @ direction))
            direction = direction - shares[-1] * bend
        if moves:
            move, bend, scale = moves[-1]
            direction = direction / (scale * (bend @ bend))
        for (move, bend, scale), share in zip(moves, reversed(shares), strict=True):
            direction = direction + (share - scale * (bend @ direction)) * move
        length, expected = 1.0 if moves else 1.0 / max(np.abs(slope).sum(), 1e-12), slope @ direction
        for _ in range(30):
            new_value, new_slope = loss(at + length * direction)
            if new_value <= value + 1e-4 * length * expected:
                break
            length /= 2
        else:
            break
        move, bend = length * direction, new_slope - slope
        if move @ bend > 1e-16:
            moves = [*moves[1 - memory :], (move, bend, 1 / (move @ bend))]
        done = value - new_value < 1e-7 * max(abs(value), 1e-3)
        at, value, slope = at + move, new_value, new_slope
        if done:
            break
    return at


def _score_batches(model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                tails = known.tails(known.scores(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(tails.sum(axis=1)),
                        *(pa.array(np.ascontiguousarray(tails[:, k])) for k in range(GRADES - 1)),
                    ],
                    ["doc_id", "expected_grade", "p_above_0", "p_above_1"],
                )

    return work


def grade_documents(docs: DataFrame, model: GradeModel | None, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, expected_grade, p_above_0, p_above_1, kept) for each row of ``docs`` (doc_id, text)."""
    texts = id_and_text(docs)
    schema = "doc_id long, expected_grade double, p_above_0 double, p_above_1 double"
    if model is None:
        empty = [F.lit(None).cast("double").alias(n) for n in ("expected_grade", "p_above_0", "p_above_1")]
        return texts.select("doc_id", *empty, F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return texts.mapInArrow(_score_batches(shared), schema).withColumn("kept", F.col("p_above_1") >= accept)
