"""LM scoring by a hashed maximum-entropy model over all words.

A token's probability is a product of two-way choices down a tree whose leaves are the model's
outcomes; each choice is a logistic model whose features are the token before (n-gram), the two
before together (n-gram), the one before that alone (skip), and a constant. Feature and choice
together are hashed into a table of weights that grows with the number of training tokens.

Outcomes are the end, every token that makes up at least 1 in HEAD of all training tokens, and
buckets of the rarer ones by hash, whose number grows with the number of their types. So the context
of any token moves its probability: a rare one has its bucket's given the context, times its
smoothed count's share of the bucket. As context, a rare token is a hashed number of its own among
RARE. Without weights each choice follows the smoothed counts, so that the model starts as their
distribution. Probabilities sum to one over all tokens, each bucket holding one unseen one.

Learning covers every training text in each round; the texts are split and looked up once, and the
numbers of their tokens kept on the executors' disks between rounds. From common weights, each task
takes steps by gradient and curvature on its part of the texts, and Spark averages the tasks' weight
changes block by block, each weighing the curvature it has seen, so that what few tasks have met
is not averaged away; the driver holds the weights.

Scoring reads each text once. Tokens so frequent that at most HEAD of them can exist are looked
up in a table of proven size; the rest, rare by the same proof, are joined to the counts.

Defined results: NULL and empty texts are their end alone. Where no text is in training, all
counts are 0, N and V are 0 and both scores are 0 for each token but for the model's outcomes,
which are then equally likely. A NULL ``doc_id`` counts as an empty id for the split. Repeated
rows are scored each, and learned from each. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import BATCH_SETTING, crc_of_id, mix, slices, stored, text_column
from orderlayers.session import setting

#: Tokens with at least N / HEAD of all N training tokens: there can be no more than HEAD.
HEAD = 1 << 17
#: Types of rare tokens a bucket, about, and most buckets.
TYPES_PER_BUCKET, BUCKETS = 16, 1 << 16
#: Numbers of rare tokens as context.
RARE = 1 << 20
#: Least and most weights (powers of two); between them, one for every so many training tokens.
WEIGHT_BITS, TOKENS_PER_WEIGHT = (18, 22), 16
ROUNDS, PARTS, BLOCKS, BATCH = 3, 24, 64, 1 << 16
#: Share of a weight's own best step that is taken, as four weights share each choice.
RATE = 0.5
#: Curvature at which half of a weight is kept after each round: what was met seldom says little.
PRIOR = 8.0
#: Number of the end of a text as token and outcome. Frequent tokens follow it, rare ones begin at
#: FIRST_RARE as tokens; START is what is before a text.
END, FIRST_RARE, START = 0, 1 << 18, (1 << 21) - 1

#: Tokens whose choices are worked out at once, and weights changed at once: arrays that fit the cache.
AT_ONCE, WEIGHTS_AT_ONCE = 1 << 11, 1 << 14
#: Tokens that a task counts at once, for Spark to add up the counts.
COUNTED = 1 << 20
#: Steps that a task gets at once, of BATCH numbers each.
STEP_ROWS = 8

#: Spark then deletes the shuffled files of a query as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)


#: Hash of the constant feature.
_CONSTANT = mix(np.zeros(1, np.uint64))


def _feature_hashes(before: np.ndarray, earlier: np.ndarray) -> list[np.ndarray]:
    """Token before, token before that (skip), both, as hashes of their own."""
    one, two = before.astype(np.uint64), earlier.astype(np.uint64)
    kind = np.uint64(1 << 60)
    return [mix(x) for x in (kind + one, np.uint64(2) * kind + two, np.uint64(3) * kind + (two << np.uint64(21)) + one)]


@dataclass
class Tree:
    """Paths of all outcomes: the choices on the way down, and whether each goes right."""

    marks: np.ndarray  # where each outcome's path begins, and one more mark
    paths: np.ndarray  # numbers of choices, doubled, and 1 if the path goes right there
    base: np.ndarray  # each choice's log odds by the smoothed counts

    @classmethod
    def of(cls, masses: np.ndarray) -> Tree:
        """Halves of about equal mass, from all outcomes down to each."""
        order = np.argsort(-masses, kind="stable")
        sums = np.concatenate([[0.0], np.cumsum(masses[order])])
        size = len(masses)
        low, high = np.zeros(min(size, 1), np.int64), np.full(min(size, 1), size)
        low, high = low[high > 1], high[high > 1]
        spots, nodes, rights, base, count = [], [], [], [], 0
        while len(low):
            half = np.searchsorted(sums, (sums[low] + sums[high]) / 2)
            half -= np.abs(sums[half - 1] - (sums[low] + sums[high]) / 2) < np.abs(sums[half] - (sums[low] + sums[high]) / 2)
            half = np.clip(half, low + 1, high - 1)
            base.append(np.log((sums[high] - sums[half]) / (sums[half] - sums[low])))
            sizes = high - low
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
            spots.append(inside)
            nodes.append(np.repeat(count + np.arange(len(low)), sizes))
            rights.append(inside >= np.repeat(half, sizes))
            count += len(low)
            low, high = np.stack([low, half], 1).ravel(), np.stack([half, high], 1).ravel()
            low, high = low[high - low > 1], high[high - low > 1]
        if not spots:
            none = np.empty(0, np.int64)
            return cls(np.zeros(size + 1, np.int64), none.astype(np.int32), none.astype(float))
        owner = order[np.concatenate(spots)]
        sort = np.argsort(owner, kind="stable")
        paths = 2 * np.concatenate(nodes)[sort] + np.concatenate(rights)[sort]
        return cls(np.searchsorted(owner[sort], np.arange(size + 1)), paths.astype(np.int32), np.concatenate(base))


@dataclass
class MaxentModel:
    tree: Tree
    bits: int = WEIGHT_BITS[0]
    weights: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        if self.weights is None:
            self.weights = np.zeros(1 << self.bits, np.float32)

    @property
    def classes(self) -> np.ndarray:
        """Each outcome is a leaf of its own: its number, and one more mark."""
        return np.arange(len(self.tree.marks))

    def _places(self, hashed: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Places of the weights of features (changed in place) and choices."""
        hashed ^= spread
        hashed *= _TURN
        hashed >>= np.uint64(64 - self.bits)
        return hashed.view(np.int64)

    def constants(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each choice: place of its constant's weight, and its log odds without any context."""
        spread = np.arange(len(self.tree.base), dtype=np.uint64) * _STEP
        places = self._places(np.repeat(_CONSTANT, len(spread)), spread)
        return places, self.tree.base + self.weights[places]

    def choices(self, alone: np.ndarray, before: np.ndarray, earlier: np.ndarray, outcome: np.ndarray):
        """Of all tokens' choices one after another: sizes by token, numbers, places of the contexts'
        weights, log odds of the way not taken, and -1 where that is left, else 1. ``alone`` are the
        choices' log odds without any context."""
        first = self.tree.marks.take(outcome)
        sizes = self.tree.marks.take(outcome + 1) - first
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        at += np.arange(len(at))
        paths = self.tree.paths.take(at)
        nodes = (paths >> 1).astype(np.int64)
        spread = nodes.view(np.uint64) * _STEP
        odds, places = alone.take(nodes), []
        for hashed in _feature_hashes(before, earlier):
            place = self._places(np.repeat(hashed, sizes), spread)
            odds += self.weights.take(place)
            places.append(place)
        side = 1.0 - 2 * (paths & 1)
        odds *= side
        return sizes, nodes, places, odds, side

    def log10(self, before: np.ndarray, earlier: np.ndarray, outcome: np.ndarray) -> np.ndarray:
        """log10 P(outcome | context)."""
        _, alone = self.constants()
        found = np.empty(len(outcome))
        for low in range(0, len(outcome), AT_ONCE):
            part = slice(low, low + AT_ONCE)
            sizes, _, _, odds, _ = self.choices(alone, before[part], earlier[part], outcome[part])
            # log(1 + e^odds), whatever the size of the odds.
            logs = np.abs(odds)
            np.negative(logs, out=logs)
            np.exp(logs, out=logs)
            logs += 1
            np.log(logs, out=logs)
            logs += np.maximum(odds, 0, out=odds)
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            marks = np.concatenate([[0], np.cumsum(sizes)])
            found[part] = (sums[marks[:-1]] - sums[marks[1:]]) / math.log(10)
        return found


def in_training(column: str = "doc_id") -> F.Column:
    return F.pmod(crc_of_id(column), F.lit(5)) != 1


def _texts(docs: DataFrame) -> DataFrame:
    """Texts as they are: A-Z are lower-cased where tokens are split."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def token_table(training: DataFrame) -> DataFrame:
    """(token, c) for all tokens but the end."""
    counted = _texts(training).select("text").mapInArrow(_count_batches, "token binary, c long")
    return counted.groupBy(F.col("token").cast("string").alias("token")).agg(F.sum("c").alias("c"))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's tokens, of COUNTED at once."""
    held, waiting = 0, []

    def found() -> pa.RecordBatch:
        counts = pa.chunked_array(waiting).value_counts()
        return pa.RecordBatch.from_arrays([counts.field("values").cast(pa.binary()), counts.field("counts")], ["token", "c"])

    for batch in batches:
        for _, _, texts in _slices(batch):
            waiting.append(_words(texts)[0])
            held += len(waiting[-1])
            if held >= COUNTED:
                yield found()
                held, waiting = 0, []
    if waiting:
        yield found()


def _slices(batch: pa.RecordBatch):
    """Slices of a batch: (first row, last row, texts)."""
    texts = batch.column(batch.schema.get_field_index("text"))
    _, offsets = text_column(texts)
    for first, last in slices(offsets):
        yield first, last, texts.slice(first, last - first)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts one after another with A-Z lower-cased, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, marks = split.flatten(), split.offsets.to_numpy()
    # White space at either end of a text leaves an empty word there.
    full = pc.binary_length(words).to_numpy() > 0
    words = words.filter(pa.array(full))
    sums = np.concatenate([[0], np.cumsum(full)])
    return words, sums[marks[1:]] - sums[marks[:-1]]


def _numbers(texts: pa.Array, head: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of the tokens of texts with their ends, lengths, and the rare tokens."""
    words, lengths = _words(texts)
    found = pc.index_in(words, value_set=head.cast(words.type)).fill_null(-1).to_numpy().astype(np.int64) + 1
    rare = found == 0
    rare_words = words.filter(pa.array(rare))
    hashes = np.fromiter(map(crc32, rare_words.cast(pa.binary()).to_pylist()), np.int64, len(rare_words))
    found[rare] = FIRST_RARE + hashes % RARE
    lengths = lengths + 1
    inner = np.ones(len(words) + len(lengths), bool)
    inner[np.cumsum(lengths) - 1] = False
    numbers = np.full(len(inner), END, np.int64)
    numbers[inner] = found
    return numbers, lengths, rare_words


def _outcomes(numbers: np.ndarray, first_bucket: int, buckets: int) -> np.ndarray:
    return np.where(numbers < FIRST_RARE, numbers, first_bucket + (numbers - FIRST_RARE) % buckets)


def _contexts(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens before and before that of all numbers of texts laid one after another but the
    first two, which come before them."""
    before, earlier = numbers[1:-1], numbers[:-2]
    first = before == END
    return np.where(first, START, before), np.where(first | (earlier == END), START, earlier)


def _step_batches(head):
    """The numbers of a task's texts, cut into steps, each behind the two numbers before it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = 0, []

        def steps() -> pa.RecordBatch:
            numbers = np.concatenate([[END, END], *waiting]).astype("<i4")
            rows = [numbers[low : low + BATCH + 2].tobytes() for low in range(0, len(numbers) - 2, BATCH)]
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["numbers"])

        for batch in batches:
            for _, _, texts in _slices(batch):
                numbers, _, _ = _numbers(texts, head.value)
                waiting.append(numbers)
                held += len(numbers)
                if held >= BATCH:
                    yield steps()
                    held, waiting = 0, []
        if waiting:
            yield steps()

    return work


def _gradient_batches(shared, first_bucket: int, buckets: int, rate: float):
    """One pass over a task's gradient steps; returns the change of the weights in blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        model = MaxentModel(base.tree, base.bits, base.weights.copy())
        curvature = np.zeros_like(model.weights)
        sums = np.zeros(len(model.weights), complex)
        for batch in batches:
            for row in batch.column(0):
                numbers = np.frombuffer(row.as_buffer(), "<i4").astype(np.int64)
                _step(model, sums, curvature, *_contexts(numbers), _outcomes(numbers[2:], first_bucket, buckets), rate)
        both = (np.array_split(x.astype("<f4"), BLOCKS) for x in (curvature, model.weights - base.weights))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int32()), *(pa.array([b.tobytes() for b in x], pa.binary()) for x in both)],
            ["block", "weight", "change"],
        )

    return work


def _step(model: MaxentModel, sums: np.ndarray, curvature: np.ndarray, before, earlier, outcome, rate: float) -> None:
    """A step on tokens in their contexts, each weight's by its slope and the curvature met so far.

    ``sums`` holds a slope and a curvature for each weight, as one complex number so that both are
    added at once; it is all zeros before and after the step."""
    constant, alone = model.constants()
    by_choice = np.zeros(len(alone), complex)
    for low in range(0, len(outcome), AT_ONCE):
        part = slice(low, low + AT_ONCE)
        _, nodes, places, odds, side = model.choices(alone, before[part], earlier[part], outcome[part])
        np.negative(odds, out=odds)
        np.exp(odds, out=odds)
        odds += 1
        missed = np.reciprocal(odds, out=odds)
        both = np.empty(len(missed), complex)
        np.multiply(missed, side, out=both.real)
        # Of a choice that is far off, the curvature is no measure of the step.
        np.multiply(missed, np.maximum(1 - missed, 0.25), out=both.imag)
        for place in places:
            np.add.at(sums, place, both)
        np.add.at(by_choice, nodes, both)
    np.add.at(sums, constant, by_choice)
    for low in range(0, len(sums), WEIGHTS_AT_ONCE):
        part = slice(low, low + WEIGHTS_AT_ONCE)
        change, bend = sums.real[part].astype(np.float32), sums.imag[part].astype(np.float32)
        curvature[part] += bend
        np.add(curvature[part], 1, out=bend)
        change *= rate
        change /= bend
        model.weights[part] -= change
        sums[part] = 0


def _mean_change(block: pa.Table) -> pa.Table:
    """Mean of the tasks' changes of a block of weights, each weighing the curvature it has seen,
    and all of that."""
    total = weights = 0.0
    for w, x in zip(block["weight"], block["change"], strict=True):
        weight = np.frombuffer(w.as_py(), "<f4").astype(np.float64)
        weights = weights + weight
        total = total + weight * np.frombuffer(x.as_py(), "<f4")
    both = ((x.astype("<f4").tobytes()) for x in (weights, total / np.maximum(weights, 1e-9)))
    return pa.table([block["block"].slice(0, 1), *(pa.array([x], pa.binary()) for x in both)], ["block", "weight", "change"])


class MaxentScorer:
    """The model and counts learned from ``training`` (doc_id, text)."""

    def __init__(self, training: DataFrame) -> None:
        spark = training.sparkSession
        self.counts = stored(token_table(training), "lm-counts")
        ends = training.count()
        row = self.counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.tokens = row["n"] + ends
        self.types = row["v"] + (1 if ends else 0)
        frequent = F.col("c") * HEAD >= self.tokens
        head = self.counts.filter(frequent).orderBy(F.desc("c"), "token").collect()
        self.base_log = math.log10(self.tokens + 0.5 * (self.types + 1))
        self.ends = ends
        #: Frequent tokens; their numbers begin at 1.
        self.head = spark.sparkContext.broadcast(pa.array([r["token"] for r in head], pa.string()))
        #: log10 of the smoothed counts of the end and the frequent tokens, by number.
        self.head_logs = np.array([math.log10(c + 0.5) for c in (ends, *(r["c"] for r in head))])
        self.first_bucket = 1 + len(head)
        types = (row["v"] - len(head)) // TYPES_PER_BUCKET
        self.buckets = min(1 << max(types, 1).bit_length() - 1, BUCKETS)
        place = F.pmod(F.pmod(F.crc32(F.col("token").cast("binary")), F.lit(RARE)), F.lit(self.buckets))
        rare = (
            self.counts.filter(~frequent).groupBy(place.cast("int").alias("bucket"))
            .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
        )
        # Smoothed counts of each bucket's tokens, and of an unseen one.
        masses = np.full(self.buckets, 0.5)
        for r in rare:
            masses[r["bucket"]] += r["c"] + 0.5 * r["v"]
        self.bucket_logs = np.log10(masses)
        tree = Tree.of(np.concatenate([[ends + 0.5], [r["c"] + 0.5 for r in head], masses]))
        self.model = self._train(training, tree)

    def _train(self, training: DataFrame, tree: Tree) -> MaxentModel:
        spark = training.sparkSession
        bits = min(max((self.tokens // TOKENS_PER_WEIGHT).bit_length(), WEIGHT_BITS[0]), WEIGHT_BITS[1])
        model = MaxentModel(tree, bits)
        if not self.ends:
            return model
        texts = _texts(training).select("text").coalesce(PARTS)
        steps = texts.mapInArrow(_step_batches(self.head), "numbers binary").persist(StorageLevel.DISK_ONLY)
        try:
            steps.count()
            for _ in range(ROUNDS):
                model = self._round(steps, model)
        finally:
            steps.unpersist(blocking=True)
        return model

    def _round(self, steps: DataFrame, model: MaxentModel) -> MaxentModel:
        spark = steps.sparkSession
        weights = spark.sparkContext.broadcast(model)
        work = _gradient_batches(weights, self.first_bucket, self.buckets, RATE)
        # No later round reads a round's changes and weights: neither stays on disk.
        with setting(spark, _CLEANUP, "true"), setting(spark, BATCH_SETTING, STEP_ROWS):
            changes = (
                steps.mapInArrow(work, "block int, weight binary, change binary")
                .groupBy("block")
                .applyInArrow(_mean_change, "block int, weight binary, change binary")
                .collect()
            )
        weights.destroy()
        changes.sort(key=lambda r: r["block"])
        seen, change = (np.concatenate([np.frombuffer(r[c], "<f4") for r in changes]) for c in ("weight", "change"))
        return MaxentModel(model.tree, model.bits, (model.weights + change) * (seen / (seen + np.float32(PRIOR))))

    def _score_batches(self):
        shared, head_logs, ends, base_log = self.head, self.head_logs, self.ends, self.base_log
        first_bucket, buckets, bucket_logs = self.first_bucket, self.buckets, self.bucket_logs
        weights = self.counts.sparkSession.sparkContext.broadcast(self.model)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            head, model = shared.value, weights.value
            for batch in batches:
                for first, last, texts in _slices(batch):
                    numbers, lengths, words = _numbers(texts, head)
                    before, earlier = _contexts(np.concatenate([[END, END], numbers]))
                    outcome = _outcomes(numbers, first_bucket, buckets)
                    chance = model.log10(before, earlier, outcome)
                    # Rare tokens' counts are added later, from the joined table.
                    tail = numbers >= FIRST_RARE
                    count = np.where(tail, 0.0, head_logs[np.where(tail, END, numbers)])
                    chance[tail] -= bucket_logs[outcome[tail] - first_bucket]
                    starts = np.cumsum(lengths) - lengths
                    base = np.add.reduceat(count, starts) - lengths * base_log
                    score = np.add.reduceat(chance, starts)
                    known = np.add.reduceat((~tail).astype(np.int64), starts)
                    if not ends:
                        known -= 1
                    rare_rows = np.add.reduceat(tail.astype(np.int64), starts)
                    marks = np.concatenate([[0], np.cumsum(rare_rows)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, last - first),
                            pa.array(lengths),
                            pa.array(known),
                            pa.array(base),
                            pa.array(score),
                            pa.ListArray.from_arrays(pa.array(marks), words.cast(pa.string())),
                        ],
                        ["doc_id", "n_tokens", "n_known", "base_score", "score", "rare"],
                    )

        return work

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``."""
        schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<string>"
        first = _texts(docs).mapInArrow(self._score_batches(), schema)
        first = stored(first.withColumn("row", F.monotonically_increasing_id()), "lm-first")
        rare = first.select("row", F.explode("rare").alias("token"))
        rarely = self.counts.filter(F.col("c") * HEAD < self.tokens)
        # An unseen token can be any text's, so it is left out by the join and counted as 0 + 0.5.
        sums = (
            rare.join(rarely, "token")
            .groupBy("row")
            .agg(F.count(F.lit(1)).alias("met"), F.sum(F.log10(F.col("c") + 0.5)).alias("logs"))
        )
        sums = stored(sums, "lm-rare")
        unseen = (F.size("rare") - F.coalesce("met", F.lit(0))) * math.log10(0.5)
        more = F.coalesce("logs", F.lit(0.0)) + unseen
        return first.join(sums, "row", "left").select(
            "doc_id",
            "n_tokens",
            (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
            F.lit(self.tokens).cast("long").alias("train_tokens"),
            (F.col("base_score") + more).alias("base_score"),
            (F.col("score") + more).alias("score"),
        )
