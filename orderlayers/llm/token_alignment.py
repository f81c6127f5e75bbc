"""Alignment of two tokenizers' tokens by the byte places where both end a token.

Each text is encoded by a byte-level BPE (A, with a space put before the text) and by a piece model
(B, which puts that space itself). A dictionary from cumulative end to index is made for each side;
the ends found in both, sorted, slice both id lists into groups. Within a group, tokens of A and B
whose byte ranges end together are linked; tokens without bytes, were there any, would be expanded
into all their links.

How often two ids are linked is counted over all texts. Links are kept as one integer each, 31 bits
for these vocabularies; slices of texts count theirs before anything is shuffled, so a pair that
holds any share of all links sends a row per slice at most. Pairs with at least 1 / FREQUENT of all
links, of which there can be no more than FREQUENT, are broadcast, with their count and whether it
is the highest of their B id; the links of rarer pairs are looked up by a join.

Defined results: a NULL or empty text has no tokens, nor has one whose tokens of either side do not
spell the text (a text with U+2581, which pieces take for a space): all counts are zero and the
groups are an empty text. Strings of special tokens inside texts are ordinary text. Rows that
repeat count each; a NULL ``doc_id`` is a row like any other; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.bpe import byte_letters
from orderlayers.llm.common import id_and_text, slices, stored, text_column

#: Pairs with at least 1 / FREQUENT of all links are broadcast (17 bytes each).
FREQUENT = 1 << 19
#: Longer texts are not given to the faster of the two encoders of A.
LONG = 1 << 18

_SPACE = "▁"


class ByteTokens:
    """A byte-level BPE file: ids of a text, and the bytes of each id.

    Where the vocabulary is one of ranks (ids in the order of the merges), texts are encoded by
    rank; texts with characters whose class has changed between versions of Unicode, and long ones,
    by the tokenizers library itself.
    """

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        self.source = source.decode()
        of_letter = {letter: byte for byte, letter in enumerate(byte_letters())}
        special = {t["id"] for t in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        coded = {token: bytes(of_letter[c] for c in token) for token, k in vocabulary.items() if k not in special}
        self.bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for token, data in coded.items():
            self.bytes[vocabulary[token]] = data
        merged = [vocabulary["".join(m) if not isinstance(m, str) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        before = spec["pre_tokenizer"]
        usual = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        ranked = merged == list(range(256, 256 + len(merged))) and usual and spec["normalizer"] is None
        self.ranks = {data: vocabulary[token] for token, data in coded.items()} if ranked else None

    def encoder(self):
        """A function from texts to arrays of ids."""
        from tokenizers import Tokenizer

        exact = Tokenizer.from_str(self.source)
        exact.encode_special_tokens = True
        exact.no_truncation()
        exact.no_padding()
        if self.ranks is None:
            return lambda text: np.array(exact.encode(text, add_special_tokens=False).ids, np.int64)
        import public_tokenizers
        import tiktoken

        fast = tiktoken.Encoding(
            uuid.uuid4().hex, pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={}
        )
        settled: set[str] = set()

        def encode(text: str) -> np.ndarray:
            if len(text) <= LONG:
                settled.update(filter(is_settled, set(text) - settled))
                if settled.issuperset(text):
                    return fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.int64)

        return encode


def is_settled(c: str) -> bool:
    """Whether a character is a letter, digit, white space or none of them in any version of Unicode since 3.2."""
    if c in "\n\r\t":
        return True
    first, now = unicodedata.ucd_3_2_0.category(c), unicodedata.category(c)
    return first == now and now[0] in "LNMPSZ"


class PieceTokens:
    """A piece model: ids of texts, and the bytes of each id."""

    def __init__(self, source: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        model.ParseFromString(source)
        self.source = source
        kind = schema.ModelProto.SentencePiece
        self.bytes = []
        for piece in model.pieces:
            if piece.type == kind.BYTE:
                self.bytes.append(bytes([int(piece.piece[1:-1], 16)]))
            else:
                self.bytes.append(piece.piece.replace(_SPACE, " ").encode())

    def encoder(self):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.source)
        return model.encode


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each end found on both sides, in order, the index of the token of A and of B that ends there."""
    at_a = dict(zip(ends_a.tolist(), range(len(ends_a))))
    at_b = dict(zip(ends_b.tolist(), range(len(ends_b))))
    common = sorted(at_a.keys() & at_b.keys())
    last_a = np.fromiter(map(at_a.__getitem__, common), np.int64, len(common))
    return last_a, np.fromiter(map(at_b.__getitem__, common), np.int64, len(common))


class _Aligner:
    """A worker's encoders and tables."""

    def __init__(self, a: ByteTokens, b: PieceTokens) -> None:
        self.bytes_b = b.bytes
        self.encode_a, self.encode_b = a.encoder(), b.encoder()
        self.sizes_a = np.array([len(x) for x in a.bytes], np.int64)
        self.sizes_b = np.array([len(x) for x in b.bytes], np.int64)
        if not self.sizes_b.all():
            raise ValueError("a piece of the model has no bytes")
        # How an id is written: within or at the end of a group, on A's and on B's side.
        ids_a, ids_b = range(len(a.bytes)), range(len(b.bytes))
        self.written = np.array(
            [f"{k}{s}" for s in ",|" for k in ids_a] + [f"{k}{s}" for s in ",;" for k in ids_b], object
        )
        self.many_a, self.many_b = len(ids_a), len(ids_b)

    def align(self, text: str):
        """Ids of A and B and, for each group, its last index in both; None without tokens."""
        if not text:
            return None
        whole = " " + text
        data = whole.encode()
        a, pieces = self.encode_a(whole), self.encode_b(text)
        b = np.array(pieces, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        # Merging never changes a byte, so A spells the text where it covers it.
        if ends_a[-1] != len(data) or b"".join(map(self.bytes_b.__getitem__, pieces)) != data:
            return None
        return a, b, *common_ends(ends_a, ends_b)

    def spelled(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """Groups as ``a1,a2|b1;a3|b2,b3``."""
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        code_a, code_b = a.copy(), b + 2 * self.many_a
        code_a[last_a] += self.many_a
        code_b[last_b] += self.many_b
        codes = np.empty(len(a) + len(b), np.int64)
        # A token of A comes after all of B in earlier groups, one of B after all of A up to its own.
        codes[np.arange(len(a)) + np.repeat(last_b - sizes_b + 1, sizes_a)] = code_a
        codes[np.arange(len(b)) + np.repeat(last_a + 1, sizes_b)] = code_b
        return "".join(self.written[codes].tolist())[:-1]


class Aligned:
    """All texts of ``docs`` (doc_id, text) aligned, stored, with the counts of linked pairs.

    ``path_a`` is a byte-level BPE file, ``path_b`` a piece model.
    """

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> None:
        self.spark = docs.sparkSession
        with open(path_a, "rb") as file_a, open(path_b, "rb") as file_b:
            a, b = ByteTokens(file_a.read()), PieceTokens(file_b.read())
        self.frequent = frequent
        self.bits = len(b.bytes).bit_length()
        if len(a.bytes).bit_length() + self.bits > 31:
            raise ValueError("a pair of ids of these vocabularies does not fit 31 bits")
        self.models = self.spark.sparkContext.broadcast((a, b))
        self.name = uuid.uuid4().hex

    def groups(self, docs: DataFrame) -> DataFrame:
        """(doc_id, a_ids, b_ids, a_last, b_last): where each group ends in both id lists."""
        name, models = self.name, self.models

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = _aligner(name, models)
            for batch in batches:
                texts = batch.column(1).fill_null("")
                _, offsets = text_column(texts)
                for first, last in slices(offsets):
                    found = [aligner.align(t) or ([], [], [], []) for t in texts.slice(first, last - first).to_pylist()]
                    lists = [pa.array([f[k] for f in found], pa.list_(pa.int32())) for k in range(4)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, last - first), *lists],
                        ["doc_id", "a_ids", "b_ids", "a_last", "b_last"],
                    )

        schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_last array<int>, b_last array<int>"
        return id_and_text(docs).mapInArrow(work, schema)

    def _digests(self, docs: DataFrame) -> DataFrame:
        """Counts, digest and links (a << bits | b) of each row."""
        name, models, bits = self.name, self.models, self.bits

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = _aligner(name, models)
            for batch in batches:
                texts = batch.column(1).fill_null("")
                _, offsets = text_column(texts)
                for first, last in slices(offsets):
                    n_a, n_b, links, digests = [], [], [], []
                    for text in texts.slice(first, last - first).to_pylist():
                        found = aligner.align(text)
                        if found is None:
                            n_a.append(0), n_b.append(0), links.append(np.empty(0, np.int32)), digests.append("")
                            continue
                        a, b, last_a, last_b = found
                        n_a.append(len(a)), n_b.append(len(b))
                        links.append((a[last_a] << bits | b[last_b]).astype(np.int32))
                        digests.append(hashlib.sha256(aligner.spelled(*found).encode()).hexdigest())
                    sizes = np.array([len(x) for x in links], np.int64)
                    marks = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, last - first),
                            pa.array(n_a, pa.int64()),
                            pa.array(n_b, pa.int64()),
                            pa.array(sizes),
                            pa.ListArray.from_arrays(pa.array(marks), pa.array(np.concatenate(links))),
                            pa.array(digests, pa.string()),
                        ],
                        ["doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256"],
                    )

        schema = "doc_id long, n_a long, n_b long, n_groups long, links array<int>, groups_sha256 string"
        return id_and_text(docs).mapInArrow(work, schema)

    def pair_counts(self, linked: DataFrame) -> DataFrame:
        """(pair, n, best): how often each pair is linked, and whether that is its B id's highest count."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _by_links(batch, 0):
                    values = part.column(0).flatten()
                    if len(values):
                        pairs, counts = np.unique(values.to_numpy(), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

        parts = linked.select("links").mapInArrow(work, "pair int, n long")
        counts = stored(parts.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
        with_b = counts.withColumn("b", F.col("pair").bitwiseAND((1 << self.bits) - 1))
        highest = with_b.groupBy("b").agg(F.max("n").alias("most"))
        return stored(
            with_b.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
            "alignment-pairs",
        )

    def digests(self, docs: DataFrame) -> DataFrame:
        """One row per row of ``docs``: counts of tokens, groups and links, and the groups' digest."""
        linked = stored(self._digests(docs).withColumn("row", F.monotonically_increasing_id()), "alignment-links")
        pairs = self.pair_counts(linked)
        total = pairs.agg(F.sum("n")).first()[0] or 0
        chosen = pairs.filter(F.col("n") * self.frequent >= total)
        table = chosen.sort("pair").toArrow()
        known = self.spark.sparkContext.broadcast(
            (table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy(zero_copy_only=False))
        )

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, counts, best = known.value
            for batch in itertools.chain.from_iterable(_by_links(b, len(kept)) for b in batches):
                column = batch.column(len(kept))
                sizes = column.value_lengths().to_numpy()
                values = column.flatten().to_numpy()
                owner = np.repeat(np.arange(len(sizes)), sizes)
                distinct, back = np.unique(values, return_inverse=True)
                at = np.searchsorted(names, distinct)
                at[at == len(names)] = 0
                hit = names[at] == distinct if len(names) else np.zeros(len(distinct), bool)
                n = np.where(hit, counts[at], 0) if len(names) else np.zeros(len(distinct), np.int64)
                is_best = hit & best[at] if len(names) else hit
                sums = np.zeros(len(sizes), np.int64)
                np.add.at(sums, owner, n[back])
                bests = np.bincount(owner, weights=is_best[back], minlength=len(sizes)).astype(np.int64)
                rare = ~hit[back]
                marks = np.concatenate([[0], np.cumsum(np.bincount(owner[rare], minlength=len(sizes)))])
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k) for k in range(len(kept))],
                        pa.array(bests),
                        pa.array(sums),
                        pa.ListArray.from_arrays(pa.array(marks.astype(np.int32)), pa.array(values[rare])),
                    ],
                    [*kept, "n_best", "count_sum", "rare"],
                )

        kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
        schema = (
            "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "n_best long, count_sum long, rare array<int>"
        )
        summed = stored(linked.select(*kept, "links").mapInArrow(work, schema), "alignment-sums")
        rare = (
            summed.select("row", F.explode("rare").alias("pair"))
            .join(pairs, "pair")
            .groupBy("row")
            .agg(F.sum("n").alias("more"), F.count_if("best").alias("more_best"))
        )
        zero = F.lit(0)
        return summed.drop("rare").join(rare, "row", "left").select(
            "doc_id", "n_a", "n_b", "n_groups",
            F.col("n_groups").alias("n_links"),
            (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"),
            "groups_sha256",
        )


def _by_links(batch: pa.RecordBatch, column: int, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold about ``limit`` links each, or one longer row."""
    ends = np.concatenate([[0], np.cumsum(batch.column(column).value_lengths().to_numpy(zero_copy_only=False))])
    for first, last in slices(ends, limit):
        yield batch.slice(first, last - first)


_aligners: dict[str, _Aligner] = {}


def _aligner(name: str, models) -> _Aligner:
    """This worker's aligner; it lives as long as the worker does."""
    if name not in _aligners:
        _aligners.clear()
        _aligners[name] = _Aligner(*models.value)
    return _aligners[name]
