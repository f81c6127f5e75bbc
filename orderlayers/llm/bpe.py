"""BPE encoding and decoding with a minimal acyclic transducer for frequent words.

A word's tokens depend on the word alone. The frequent words of all texts, counted by Spark, are
encoded once and compiled into a minimal acyclic automaton: equal suffixes share their states.
Each arc carries the number of words that sort before it, so the sum over a word's path is the
word's place in the table of id outputs. Automaton and outputs are one file, which Spark sends to
the executors and the Python workers map into memory. Words that are not in it are merged exactly,
all new words of a slice of texts at once in numpy.

The tokenizer file (word-end BPE: its normaliser composes, lower-cases and unifies white space)
is a parameter and is read by the driver alone. How single characters are lower-cased and whether
they are letters, digits or white space is asked of the tokenizer's own normaliser and pattern,
once for each character and worker, so that all versions of Unicode agree.

Defined results: NULL and empty texts have no tokens, and decode to an empty text. Strings of
special tokens inside texts are those tokens. Repeated rows get equal results; a NULL ``doc_id``
is a row like any other; other columns are not read. Texts are encoded whole, row by row.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import id_and_text, slices, stored, text_column

#: Words with at least 1 / FREQUENT of all words are compiled into the transducer, so there can be
#: no more than FREQUENT; and words that a worker remembers besides.
FREQUENT, REMEMBERED = 1 << 16, 1 << 18
#: Longer words are merged, never compiled.
LONGEST_COMPILED = 64
_NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabularies of byte-level tokenizers."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [""] * 256, 0x100
    for byte in range(256):
        if byte in plain:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(spare)
            spare += 1
    return letters


class Vocabulary:
    """What encoding needs of a tokenizer file, as arrays."""

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.spaces = spec["normalizer"]["normalizers"][1]["pattern"]["Regex"]
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, k in [*ids.items(), *self.special.items()]:
            self.tokens[k] = token
        letters = byte_letters()
        self.inner = np.array([ids[x] for x in letters], np.int64)
        self.last = np.array([ids[x + end] for x in letters], np.int64)
        pairs = np.array([(ids[a] << 20) | ids[b] for a, b in model["merges"]], np.int64)
        merged = np.array([ids[a + b] for a, b in model["merges"]], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks, self.merged = pairs[order], order.astype(np.int64), merged
        # Merging every place of the best pair at once is what merging one by one does, as long
        # as no pair is better than the merges that made its parts.
        made = {int(token): rank for rank, token in reversed(list(enumerate(merged)))}
        for rank, (a, b) in enumerate(model["merges"]):
            if max(made.get(ids[a], -1), made.get(ids[b], -1)) >= rank:
                raise ValueError("a merge of this tokenizer comes before the merges of its parts")

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and each word's first place (words + 1 marks)."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        marks = np.concatenate([[0], np.cumsum(sizes)])
        symbols = self.inner[data]
        symbols[marks[1:] - 1] = self.last[data[marks[1:] - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_words, done_symbols = [], []
        while len(symbols):
            key = (symbols[:-1] << 20) | symbols[1:]
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            rank = np.where((self.pairs[at] == key) & (word[:-1] == word[1:]), self.ranks[at], _NONE)
            rank = np.append(rank, _NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            lengths = np.diff(np.append(first, len(word)))
            best = np.repeat(best, lengths)
            finished = best == _NONE
            if finished.any():
                done_words.append(word[finished])
                done_symbols.append(symbols[finished])
                going_on = ~finished
                symbols, word, rank, best = symbols[going_on], word[going_on], rank[going_on], best[going_on]
                if not len(symbols):
                    break
            hit = rank == best
            # Of hits side by side (the pair of a letter with itself), every other one counts.
            place = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, 0))
            hit &= (place - run_start) % 2 == 0
            where = np.flatnonzero(hit)
            symbols[where] = self.merged[rank[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, word = symbols[keep], word[keep]
        all_words = np.concatenate(done_words) if done_words else np.empty(0, np.int64)
        all_symbols = np.concatenate(done_symbols) if done_symbols else np.empty(0, np.int64)
        order = np.argsort(all_words, kind="stable")
        counts = np.bincount(all_words, minlength=len(words))
        return all_symbols[order], np.concatenate([[0], np.cumsum(counts)])


def compile_lexicon(words: list[bytes], outputs: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted ``words``, with their outputs, as arrays.

    ``arc`` holds state << 8 | byte of every arc in order, ``target`` where it leads, ``skip``
    how many words sort before those beyond it, ``final`` whether a word ends in a state.
    """
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs_of: list[list[tuple[int, int]]] = []
    below: list[int] = []

    def settle(arcs: list[tuple[int, int]], final: bool) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(finals)
            finals.append(final)
            arcs_of.append(list(arcs))
            below.append(final + sum(below[t] for _, t in arcs))
        return register[key]

    open_states: list[list] = [[[], False]]
    path: list[int] = []
    before = b""
    for word in words:
        common = len(os.path.commonprefix([before, word]))
        while len(path) > common:
            arcs, final = open_states.pop()
            open_states[-1][0].append((path.pop(), settle(arcs, final)))
        for byte in word[common:]:
            open_states.append([[], False])
            path.append(byte)
        open_states[-1][1] = True
        before = word
    while path:
        arcs, final = open_states.pop()
        open_states[-1][0].append((path.pop(), settle(arcs, final)))
    root = settle(*open_states[0])
    arc, target, skip = [], [], []
    for state, arcs in enumerate(arcs_of):
        passed = int(finals[state])
        for byte, to in arcs:
            arc.append(state << 8 | byte)
            target.append(to)
            skip.append(passed)
            passed += below[to]
    marks = np.concatenate([[0], np.cumsum([len(x) for x in outputs])])
    return {
        "arc": np.array(arc, np.int64),
        "target": np.array(target, np.int64),
        "skip": np.array(skip, np.int64),
        "final": np.array(finals, np.int64),
        "root": np.array([root], np.int64),
        "marks": marks.astype(np.int64),
        "ids": np.concatenate(outputs).astype(np.int64) if outputs else np.empty(0, np.int64),
    }


def lookup(lexicon: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Each word's place among the compiled words, or -1: all words walk at once, byte by byte."""
    sizes = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    state = np.full(len(words), lexicon["root"][0])
    place = np.zeros(len(words), np.int64)
    arc = lexicon["arc"]
    alive = np.arange(len(words)) if len(arc) else np.empty(0, np.int64)
    if not len(arc):
        state[:] = -1
    for depth in range(min(int(sizes.max(initial=0)), LONGEST_COMPILED)):
        alive = alive[sizes[alive] > depth]
        if not len(alive):
            break
        key = state[alive] << 8 | data[starts[alive] + depth]
        at = np.minimum(np.searchsorted(arc, key), len(arc) - 1)
        found = arc[at] == key
        state[alive[~found]] = -1
        alive, at = alive[found], at[found]
        place[alive] += lexicon["skip"][at]
        state[alive] = lexicon["target"][at]
    ends = (state >= 0) & (sizes <= LONGEST_COMPILED)
    ends[ends] = lexicon["final"][state[ends]] == 1
    return np.where(ends, place, -1)


_ORDER = ("arc", "target", "skip", "final", "root", "marks", "ids")


def save_lexicon(lexicon: dict[str, np.ndarray], path: str) -> None:
    sizes = np.array([len(lexicon[k]) for k in _ORDER], np.int64)
    np.concatenate([sizes, *(lexicon[k] for k in _ORDER)]).tofile(path)


def map_lexicon(path: str) -> dict[str, np.ndarray]:
    whole = np.memmap(path, np.int64, "r")
    ends = len(_ORDER) + np.cumsum(np.append(0, whole[: len(_ORDER)]))
    return {k: whole[ends[i] : ends[i + 1]] for i, k in enumerate(_ORDER)}


class _Encoder:
    """A worker's encoder: the mapped lexicon, what it has learned of characters, recent words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: dict[str, np.ndarray]) -> None:
        from tokenizers import Regex, normalizers, pre_tokenizers

        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.compose = normalizers.NFC().normalize_str
        self.alone = normalizers.Sequence(
            [normalizers.Replace(Regex(vocabulary.spaces), " "), normalizers.Lowercase()]
        ).normalize_str
        self.split = pre_tokenizers.Split(Regex(vocabulary.pattern), "removed", invert=True).pre_tokenize_str
        self.folds: dict[int, str] = {}
        self.letters, self.digits, self.seen = set(), set(), set()
        # The alternatives that come before the three classes of the tokenizer's pattern.
        self.head = vocabulary.pattern.partition("[")[0]
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self._learn({chr(c) for c in range(128)})

    def _learn(self, characters: set[str]) -> None:
        """Fold and class of characters not met before; the word pattern then knows them."""
        for c in characters:
            self.folds[ord(c)] = self.alone(c)
        for c in {x for y in characters for x in self.folds[ord(y)]} | characters:
            parts = [x for x, _ in self.split(f"a{c}{c}1")]
            if parts == [f"a{c}{c}", "1"]:
                self.letters.add(c)
            elif parts == ["a", c, c, "1"]:
                self.digits.add(c)
        self.seen |= characters
        letters = "".join(map(re.escape, sorted(self.letters)))
        digits = "".join(map(re.escape, sorted(self.digits)))
        self.words = re.compile(f"{self.head}[{letters}]+|[{digits}]|[^ {letters}{digits}]+").findall

    def cut(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if not text.isascii():
            if max(text) >= "̀":
                text = self.compose(text)
            new = set(text) - self.seen
            if new:
                self._learn(new)
        return self.words(text.translate(self.folds))

    def resolve(self, words: set[str]) -> None:
        """Make sure that ``ids`` and ``texts`` hold all of ``words``."""
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.texts.clear()
        new = [w for w in words if w not in self.ids]
        if not new:
            return
        coded = [w.encode() for w in new]
        place = lookup(self.lexicon, coded)
        lexicon, tokens = self.lexicon, self.vocabulary.tokens
        unknown = np.flatnonzero(place < 0)
        flat, marks = self.vocabulary.merge([coded[k] for k in unknown])
        ids_marks, ids = lexicon["marks"], lexicon["ids"]
        for k in np.flatnonzero(place >= 0):
            own = ids[ids_marks[place[k]] : ids_marks[place[k] + 1]]
            self.ids[new[k]] = own.astype("<u4").tobytes()
            self.texts[new[k]] = " ".join([tokens[i] for i in own.tolist()])
        merged, flat = flat.astype("<u4").tobytes(), flat.tolist()
        for j, k in enumerate(unknown):
            low, high = int(marks[j]), int(marks[j + 1])
            self.ids[new[k]] = merged[4 * low : 4 * high]
            self.texts[new[k]] = " ".join([tokens[i] for i in flat[low:high]])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids (unsigned 32-bit, little-endian) and decoded text of each text."""
        cuts: list[list[str]] = []
        special = self.special
        for text in texts:
            if special and "<" in text and special.search(text):
                words: list[str] = []
                for k, part in enumerate(special.split(text)):
                    words += [part] if k % 2 else self.cut(part)
                cuts.append(words)
            else:
                cuts.append(self.cut(text))
        self.resolve(set().union(*cuts) - set(self.vocabulary.special))
        ids, decoded = self.ids, self.texts
        for token, k in self.vocabulary.special.items():
            ids[token], decoded[token] = k.to_bytes(4, "little"), token
        for words in cuts:
            yield b"".join([ids[w] for w in words]), " ".join([decoded[w] for w in words])


class BpeCodec:
    """Encoder and decoder for a tokenizer file, with the frequent words of given texts compiled."""

    def __init__(self, docs: DataFrame, path: str, frequent: int = FREQUENT) -> None:
        spark = docs.sparkSession
        with open(path, "rb") as file:
            vocabulary = Vocabulary(file.read())
        lower = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
        words = docs.select(F.explode(F.split(lower, r"[^\p{L}]+")).alias("word")).filter(
            F.length("word").between(1, LONGEST_COMPILED)
        )
        counts = stored(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "bpe-words")
        total = counts.agg(F.sum("n")).first()[0] or 0
        chosen = [r["word"].encode() for r in counts.filter(F.col("n") * frequent >= total).select("word").collect()]
        chosen = sorted(w for w in chosen if len(w) <= LONGEST_COMPILED)
        flat, marks = vocabulary.merge(chosen)
        lexicon = compile_lexicon(chosen, np.split(flat, marks[1:-1]) if chosen else [])
        folder = tempfile.mkdtemp(prefix="orderlayers-lexicon-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        self.name = f"lexicon-{uuid.uuid4().hex}.bin"
        save_lexicon(lexicon, f"{folder}/{self.name}")
        spark.sparkContext.addFile(f"{folder}/{self.name}")
        self.vocabulary = spark.sparkContext.broadcast(vocabulary)
        self.tokens = vocabulary.tokens

    def _batches(self, whole: bool):
        name, vocabulary = self.name, self.vocabulary

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(name, vocabulary)
            for batch in batches:
                texts = batch.column(1).fill_null("")
                _, offsets = text_column(texts)
                for first, last in slices(offsets):
                    out: list[list] = [[], [], []]
                    for ids, text in encoder.encode(texts.slice(first, last - first).to_pylist()):
                        out[0].append(len(ids) // 4)
                        if whole:
                            out[1].append(np.frombuffer(ids, "<u4").astype(np.int32))
                            out[2].append(text)
                        else:
                            out[1].append(hashlib.sha256(ids).hexdigest())
                            out[2].append(hashlib.sha256(text.encode()).hexdigest())
                    ids_type = pa.list_(pa.int32()) if whole else pa.string()
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, last - first),
                            pa.array(out[0], pa.int64()),
                            pa.array(out[1], ids_type),
                            pa.array(out[2], pa.string()),
                        ],
                        ["doc_id", "n_tokens", "ids", "decoded"],
                    )

        return work

    def encode(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_tokens, ids array<int>, decoded) for each row of ``docs`` (doc_id, text)."""
        return id_and_text(docs).mapInArrow(
            self._batches(True), "doc_id long, n_tokens long, ids array<int>, decoded string"
        )

    def digests(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` without its bulk."""
        return (
            id_and_text(docs)
            .mapInArrow(self._batches(False), "doc_id long, n_tokens long, ids string, decoded string")
            .withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})
        )

    def decode(self, encoded: DataFrame, column: str = "ids") -> DataFrame:
        """``encoded`` with the text of its ids in ``decoded``; a NULL list stays NULL."""
        tokens = F.array(*map(F.lit, self.tokens))
        return encoded.withColumn(
            "decoded", F.array_join(F.transform(F.col(column), lambda k: F.element_at(tokens, k + 1)), " ")
        )


_encoders: dict[str, _Encoder] = {}


def _encoder(name: str, vocabulary) -> _Encoder:
    """This worker's encoder for a lexicon; it lives as long as the worker does."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = _Encoder(vocabulary.value, map_lexicon(SparkFiles.get(name)))
    return _encoders[name]
