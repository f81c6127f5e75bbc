"""Token counts by dynamic programming over prefixes.

For every prefix of a text the exact number of tokens is known, so how much of it fits a budget,
or how many tokens its first n characters have, needs no encoding again.

Pieces are merged by score alone, so an encoding is the tokenizer's own exactly if each pair of
neighbouring pieces, merged on its own, stays that pair: as long as nothing has merged across a
border, both sides merge as they would alone. The last piece of a prefix therefore is the one
piece that ends it and stays apart from the last piece of the prefix before it, and the prefix
has one token more than that one. Whether two pieces stay apart is worked out by merging the two
and remembered.

No piece reaches from anything into following white space, nor (but for a few characters, which
are read off the model) from a letter or digit to a following sign, nor over a line end. So a
text falls into units, such as a word with the white space and signs before it, that are worked
out once and remembered; a text's prefix counts are those of its units, one upon the other.
Characters that are no piece count their bytes (byte fallback).

``prefix_store`` keeps for each character by how much it changes the count of the prefix it ends,
one signed byte each, so the store is no larger than the texts. ``budget_answers`` reads token
counts and cuts within a budget off the store; it knows neither the texts nor the model.

Defined results: NULL and empty texts have no tokens and one prefix, the empty one. Strings of
special tokens inside texts are ordinary text. Repeated rows get equal results, a NULL ``doc_id``
is a row like any other, other columns are not read. Prefixes count code points.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import id_and_text, slices, text_column

#: Units and pairs that a worker remembers before it starts afresh, and the longest such unit:
#: together they bound a worker's memory by about 250 MB.
REMEMBERED, LONGEST_REMEMBERED = 1 << 19, 64
SPACE = "▁"


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Pieces:
    """What counting needs of a piece model: the pieces' order of merging."""

    def __init__(self, source: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        model.ParseFromString(source)
        normal = [p for p in model.pieces if p.type == schema.ModelProto.SentencePiece.NORMAL]
        spec = model.normalizer_spec
        plain = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
        if not (plain and model.trainer_spec.byte_fallback and model.trainer_spec.model_type == 2):
            raise ValueError("a BPE model with byte fallback and without normalisation is needed")
        if any(SPACE in p.piece.lstrip(SPACE) or "\n" in p.piece for p in normal):
            raise ValueError("a piece of this model has white space behind other characters")
        order = sorted(normal, key=lambda p: -p.score)
        self.rank = {p.piece: k for k, p in enumerate(order)}
        self.longest = max(map(len, self.rank))
        # How long a piece with these last three characters can be.
        self.reach: dict[str, int] = {}
        for p in self.rank:
            self.reach[p[-3:]] = max(len(p), self.reach.get(p[-3:], 2))
        # A character takes a count back at most to where the longest piece begins, four bytes
        # for each of its characters, and so changes it by no more than a signed byte holds.
        if 4 * self.longest > 127:
            raise ValueError("pieces of this model are too long for steps of one byte")
        # Letters and digits that some piece ties to a following sign.
        self.tied = "".join(sorted({a for p in self.rank for a, b in zip(p, p[1:]) if _is_word(a) and not _is_word(b)}))
        # White space, signs, letters: a unit ends where a letter or digit is followed by a sign.
        sign, letter = f"[^\\w{SPACE}\n]", "\\w"
        self.units = f"{SPACE}+{sign}*{letter}*|{sign}+{letter}*|{letter}+|\n"
        if self.tied:
            tied = re.escape(self.tied)
            sign, letter = f"(?:{sign}|[{tied}])", f"[^\\W{tied}]"
        self.tied_units = f"{SPACE}+{sign}*{letter}*|{sign}+{letter}*|{letter}+|\n"

    def merge(self, text: str) -> list[str]:
        """The tokenizer's pieces of ``text``, best pair first, the leftmost of equal ones."""
        rank = self.rank
        parts: list[str | None] = list(text)
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap: list[tuple[int, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            score = rank.get(parts[i] + parts[j])
            if score is not None:
                heapq.heappush(heap, (score, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]


class PrefixCounter:
    """Counts with memory; one lives in each Python worker."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self._units = re.compile(pieces.units).findall
        self._tied_units = re.compile(pieces.tied_units).findall

    def units(self, text: str) -> list[str]:
        text = SPACE + text.replace(" ", SPACE)
        return (self._tied_units if any(c in text for c in self.pieces.tied) else self._units)(text)

    def _stays_apart(self, left: str, right: str) -> bool:
        known = self.pieces.merge(left + right) == [left, right]
        if len(self.apart) > REMEMBERED:
            self.apart.clear()
        self.apart[left, right] = known
        return known

    def unit(self, unit: str) -> list[int]:
        """Token count of each prefix of a unit, from its first character on."""
        rank, apart, reach = self.pieces.rank, self.apart, self.pieces.reach
        counts = [0]
        lasts = [""]
        for end in range(1, len(unit) + 1):
            longest = reach.get(unit[end - 3 : end], 2) if end > 2 else 2
            for start in range(end - longest if longest < end else 0, end):
                piece = unit[start:end]
                if piece not in rank:
                    continue
                last = lasts[start]
                if not last:  # nothing before, or a character that is no piece
                    fits = end - start == 1 or self._whole(piece)
                else:
                    fits = apart.get((last, piece))
                    if fits is None:
                        fits = self._stays_apart(last, piece)
                if fits:
                    counts.append(counts[start] + 1)
                    lasts.append(piece)
                    break
            else:
                counts.append(counts[-1] + len(unit[end - 1].encode()))
                lasts.append("")
        return counts[1:]

    def _whole(self, piece: str) -> bool:
        """Whether a piece's own text is merged into it."""
        fits = self.apart.get(("", piece))
        if fits is None:
            fits = self.apart["", piece] = self.pieces.merge(piece) == [piece]
        return fits

    def _unit_steps(self, unit: str) -> bytes:
        """By how much each character of a unit changes the count, as signed bytes."""
        counts = self.unit(unit)
        steps = bytes([(b - a) & 255 for a, b in zip([0, *counts], counts)])
        if len(unit) <= LONGEST_REMEMBERED:
            self.known[unit] = steps
        return steps

    def steps(self, text: str) -> np.ndarray:
        """By how much each character changes the token count of the prefix that it ends."""
        if not text:
            return np.zeros(0, np.int8)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        units = self.units(text)
        parts = list(map(self.known.get, units))
        at = -1
        for _ in range(parts.count(None)):
            at = parts.index(None, at + 1)
            parts[at] = self.known.get(units[at]) or self._unit_steps(units[at])
        found = np.frombuffer(b"".join(parts), np.int8)
        # The white space put before a text is no character of it; its step is the first one's.
        steps = found[1:].copy()
        steps[0] += found[0]
        return steps

    def total(self, text: str) -> int:
        """Token count of a whole text."""
        return int(self.steps(text).sum(dtype=np.int64))

    def every(self, text: str) -> np.ndarray:
        """Token count of each prefix of a text, the empty one first."""
        return counts_of(self.steps(text))


def counts_of(steps: np.ndarray) -> np.ndarray:
    """Token count of each prefix, the empty one first, from the steps between them."""
    counts = np.zeros(len(steps) + 1, np.int32)
    np.cumsum(steps, dtype=np.int32, out=counts[1:])
    return counts


_counters: dict[str, PrefixCounter] = {}


def _counter(pieces) -> PrefixCounter:
    if pieces.id not in _counters:
        _counters.clear()
        _counters[pieces.id] = PrefixCounter(pieces.value)
    return _counters[pieces.id]


class _Shared:
    """A broadcast with a name of its own, by which workers find their counter again."""

    def __init__(self, spark, path: str) -> None:
        with open(path, "rb") as file:
            pieces = Pieces(file.read())
        self.broadcast = spark.sparkContext.broadcast(pieces)
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> Pieces:
        return self.broadcast.value

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}


def prefix_store(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, steps) for each row of ``docs`` (doc_id, text); ``path`` is the model file.

    ``steps`` holds a signed byte for each character; the sum of the first k of them is the exact
    token count of the first k characters.
    """
    pieces = _Shared(docs.sparkSession, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(pieces)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            _, offsets = text_column(texts)
            for first, last in slices(offsets):
                found = [counter.steps(t).tobytes() for t in texts.slice(first, last - first).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(offsets[first : last + 1])),
                        pa.array(found, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "steps"],
                )

    return id_and_text(docs).mapInArrow(work, "doc_id long, n_bytes long, steps binary")


def budget_answers(store: DataFrame, budget: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_chars, fitting_chars) from a store.

    ``fitting_chars`` is the length of the longest prefix of at most ``budget`` tokens. A longer
    prefix may have fewer tokens, so it's not where counts first pass the budget.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            tokens, fitting = np.zeros((2, len(column)), np.int64)
            sizes = np.zeros(len(column), np.int64)
            for k, value in enumerate(column):
                steps = np.frombuffer(value.as_buffer(), np.int8)
                sizes[k], tokens[k] = len(steps), steps.sum(dtype=np.int64)
                if tokens[k] <= budget:
                    fitting[k] = len(steps)
                else:
                    fits = np.flatnonzero(counts_of(steps) <= budget)
                    fitting[k] = fits[-1] if len(fits) else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, (tokens, sizes, fitting))],
                ["doc_id", "n_bytes", "n_tokens", "n_chars", "fitting_chars"],
            )

    return store.select("doc_id", "n_bytes", "steps").mapInArrow(
        work, "doc_id long, n_bytes long, n_tokens long, n_chars long, fitting_chars long"
    )


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs``: the last of its prefix counts."""
    return budget_answers(prefix_store(docs, path), 0).select("doc_id", "n_bytes", "n_tokens")


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, prefix_tokens): the count of every prefix, by number of characters from 0."""
    pieces = _Shared(docs.sparkSession, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(pieces)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            _, offsets = text_column(texts)
            for first, last in slices(offsets):
                found = [counter.every(t) for t in texts.slice(first, last - first).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(first, last - first) for c in (0, 1)]
                    + [pa.array(found, pa.list_(pa.int32()))],
                    ["doc_id", "text", "prefix_tokens"],
                )

    return id_and_text(docs).mapInArrow(work, "doc_id long, text string, prefix_tokens array<int>")


def tokens_of_first(characters: Column, counts: str = "prefix_tokens") -> Column:
    """How many tokens the first ``characters`` of a text have."""
    return F.element_at(counts, F.least(characters, F.size(counts) - 1) + 1)


def characters_within(budget: Column, counts: str = "prefix_tokens") -> Column:
    """The length of the longest prefix of at most ``budget`` tokens.

    A longer prefix may have fewer tokens, so this is not where counts first pass the budget.
    """
    places = F.transform(counts, lambda n, k: F.when(n <= budget, k).otherwise(0))
    return F.array_max(places)
