"""Document fingerprints by SpotSigs: chains of content words that follow common-word anchors.

Anchors are the words that hold at least ``ANCHOR_SHARE`` of all words of the corpus (so there are
few of them, in whatever languages), or a set given by the caller. Every anchor in a text, with
the next ``CHAIN`` words behind it that are no anchors, is a spot signature; the set of a text's
signatures is its fingerprint, written as one hexadecimal number of 12 digits after another, in
order. Running text is full of anchors while lists, menus and junk have few, so the fingerprint
follows the prose of a document. Words are runs of ASCII letters, digits and anything beyond ASCII,
A-Z lower-cased.

The likeness of two fingerprints is the Jaccard similarity of their sets; sets whose sizes alone
keep them below an asked similarity are never compared. ``spot_components`` finds all near copies:
sets are partitioned by length, so that only neighbouring partitions can match, and compared where
they share one of their rarest signatures.

Anchors are found in two passes without moving the words. In the first, each task keeps a summary
of ``SUMMARY`` words whose counts are at most 1 / SUMMARY of the task's words too low; the words
that may have the asked share by that, of which there can be few, are counted in the second.

Defined results: a NULL text is an empty one. A text with words but without a signature has all its
words as its only signature, a text without a word has itself, an empty text has none. Equal
fingerprints, empty ones too, have likeness 1. Rows that repeat both doc_id and text are one
document, and each gets its result; texts with the same doc_id follow each other in a fixed order, NULL
ids come last. A lone document is the one after itself. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import ALNUM, id_and_text, mix, stored, text_slices, word_bounds, word_hashes

#: A word is an anchor from this share of all words on; content words in a chain.
ANCHOR_SHARE, CHAIN = 1 / 1024, 2
#: Words in a task's summary.
SUMMARY = 8192
#: Ranges of documents for each shuffle partition, so that these get about equally many rows.
RANGES = 8
#: Bytes of a signature.
WIDTH = 6
_MASK = np.uint64((1 << 8 * WIDTH) - 1)


def common_words(docs: DataFrame, share: float = ANCHOR_SHARE) -> np.ndarray:
    """Sorted hashes of the words that hold at least ``share`` of all words, at most 1 / share."""

    def slices_of(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for _, _, data, offsets in text_slices(batch):
                starts, ends, _ = word_bounds(data, offsets, ALNUM)
                yield np.unique(word_hashes(data, starts, ends), return_counts=True)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sums, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        for words, counts in slices_of(batches):
            names, back = np.unique(np.concatenate([names, words]), return_inverse=True)
            sums = np.bincount(back, np.concatenate([sums, counts]), len(names)).astype(np.int64)
            total += int(counts.sum())
            if len(names) > SUMMARY:
                sums -= np.partition(sums, -SUMMARY - 1)[-SUMMARY - 1]
                names, sums = names[sums > 0], sums[sums > 0]
        yield _counts(total, names, sums)

    def counts_of(work) -> tuple[DataFrame, int]:
        parts = id_and_text(docs).mapInArrow(work, "word long, n long")
        counts = stored(parts.groupBy("word").agg(F.sum("n").alias("n")), "spot-counts")
        total = counts.filter("word is null").first()
        return counts.filter("word is not null"), total["n"] if total else 0

    def at_least(counts: DataFrame, n: float) -> np.ndarray:
        chosen = counts.filter(F.col("n") >= n).select("word").toArrow()
        return np.sort(chosen["word"].to_numpy().view(np.uint64))

    estimates, total = counts_of(summary)
    known = at_least(estimates, (share - 1 / SUMMARY) * total)
    if not len(known):
        return known
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        sums, total = np.zeros(len(names), np.int64), 0
        for words, counts in slices_of(batches):
            at = np.minimum(np.searchsorted(names, words), len(names) - 1)
            hit = names[at] == words
            sums[at[hit]] += counts[hit]
            total += int(counts.sum())
        yield _counts(total, names[sums > 0], sums[sums > 0])

    exact, total = counts_of(counted)
    return at_least(exact, share * total)


def _counts(total: int, names: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Rows of words and counts, the total under NULL."""
    words = pa.array([None, *names.view(np.int64).tolist()], pa.int64())
    return pa.RecordBatch.from_arrays([words, pa.array([total, *sums.tolist()], pa.int64())], ["word", "n"])


def spot_sets(data: np.ndarray, offsets: np.ndarray, anchors: np.ndarray, chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted distinct signatures of each row."""
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    words = word_hashes(data, starts, ends)
    if len(anchors):
        is_anchor = anchors[np.minimum(np.searchsorted(anchors, words), len(anchors) - 1)] == words
    else:
        is_anchor = np.zeros(len(words), bool)
    content = words[~is_anchor]
    # How many content words come before each word: the place of the first one behind an anchor.
    behind = np.concatenate([[0], np.cumsum(~is_anchor)])
    spots = np.flatnonzero(is_anchor)
    place = behind[spots]
    row = np.searchsorted(first, spots, "right") - 1
    whole = place + chain <= behind[first[row + 1]]
    spots, place, row = spots[whole], place[whole], row[whole]
    signatures = words[spots]
    for k in range(chain):
        signatures = mix(signatures * np.uint64(0x9E3779B97F4A7C15) + content[place + k])
    signatures &= _MASK
    marks = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for k in range(len(offsets) - 1):
        if marks[k + 1] > marks[k]:
            out.append(np.unique(signatures[marks[k] : marks[k + 1]]))
            continue
        if first[k + 1] > first[k]:
            plain = words[first[k] : first[k + 1]].tobytes()
        else:
            plain = data[offsets[k] : offsets[k + 1]].tobytes()
        digest = hashlib.blake2b(plain, digest_size=WIDTH).digest()
        out.append(np.array([int.from_bytes(digest)] if plain else [], np.uint64))
    return out


def as_text(signatures: np.ndarray) -> str:
    return signatures.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDTH :].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 where their sizes alone keep it below ``least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def _sets_of(texts: list[str], anchors: np.ndarray) -> list[np.ndarray]:
    coded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
    return spot_sets(np.frombuffer(b"".join(coded), np.uint8), offsets, anchors)


def fingerprints(docs: DataFrame, anchors: np.ndarray) -> DataFrame:
    """(doc_id, fingerprint) of each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(anchors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                found = [as_text(s) for s in spot_sets(data, offsets, shared.value)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(found, pa.string())],
                    ["doc_id", "fingerprint"],
                )

    return id_and_text(docs).mapInArrow(work, "doc_id long, fingerprint string")


def _ranges(keys: DataFrame) -> list[tuple]:
    """The first document of each of the ranges that ``keys`` (doc_id, key) are cut into, in order.

    Only these come to the driver, ``RANGES`` for a shuffle partition.
    """
    parts = RANGES * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    ranged = keys.repartitionByRange(parts, *order).select(
        F.spark_partition_id().alias("part"),
        F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("falling"), "key").alias("place"),
    )
    firsts = ranged.groupBy("part").agg(F.min("place").alias("place")).select("place.*").collect()
    return sorted((row["none"], row["falling"] or 0, row["key"]) for row in firsts)


def _packed(docs: DataFrame, firsts) -> DataFrame:
    """Texts, compressed so that moving them costs less than half, with the range they belong to.

    Rows that repeat within a batch become one. The first document of a range is sent as a guest to
    the range before as well, the first of all to the last one.
    """
    texts = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, bounds = zstandard.ZstdCompressor(level=3).compress, firsts.value
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            copies: dict[tuple, list[int]] = {}
            for k, place in enumerate((d is None, -(d or 0), key) for d, key in zip(ids, keys)):
                copies.setdefault(place, [k, 0])[1] += 1
            rows = []
            for place, (k, n) in copies.items():
                part = bisect.bisect_right(bounds, place) - 1
                row = {"doc_id": ids[k], "key": keys[k], "copies": n, "packed": squeeze(batch.column(1)[k].as_buffer())}
                rows.append({"part": part, "guest": False, **row})
                if bounds[part] == place:
                    rows.append({"part": (part - 1) % len(bounds), "guest": True, **row})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [
            ("part", pa.int64()), ("guest", pa.bool_()), ("doc_id", pa.int64()), ("key", pa.int64()),
            ("copies", pa.int64()), ("packed", pa.binary()),
        ]
    )
    return texts.mapInArrow(work, "part long, guest boolean, doc_id long, key long, copies long, packed binary")


@dataclass
class _Document:
    part: int
    guest: bool
    doc_id: int | None
    key: int
    copies: int
    text: str


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[_Document]:
    """The documents of sorted batches; rows of one document become one."""
    loosen = zstandard.ZstdDecompressor().decompress
    last = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(5)]
        for k, (part, guest, doc_id, key, copies) in enumerate(zip(*columns)):
            if last and (last.part, last.guest, last.doc_id, last.key) == (part, guest, doc_id, key):
                last.copies += copies
                continue
            if last:
                yield last
            last = _Document(part, guest, doc_id, key, copies, loosen(batch.column(5)[k].as_buffer()).decode())
    if last:
        yield last


def _runs(documents: Iterator[_Document], limit: int = 1 << 20) -> Iterator[list[_Document]]:
    """Lists of about ``limit`` characters; each begins with the last document of the one before."""
    run, size = [], 0
    for document in documents:
        run.append(document)
        size += len(document.text)
        if size >= limit and len(run) > 1:
            yield run
            run, size = run[-1:], len(document.text)
    if len(run) > 1:
        yield run


def compare_edited(docs: DataFrame, anchors: np.ndarray | None = None) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has its last third replaced by the beginning of the next document. Documents
    are cut into ranges of doc_id, and texts move once, compressed, into their range's order.
    """
    if anchors is None:
        anchors = common_words(docs)
    context = docs.sparkSession.sparkContext
    texts = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = stored(texts.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).distinct(), "spot-keys")
    known, firsts = context.broadcast(anchors), context.broadcast(_ranges(keys))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(_documents(batches)):
            sets = _sets_of([d.text for d in run], known.value)
            pairs = [(k, d) for k, d in enumerate(run[:-1]) if not d.guest]
            edited = [d.text[: len(d.text) - len(d.text) // 3] + run[k + 1].text[: len(d.text) // 3] for k, d in pairs]
            rows = []
            for (k, d), text, other in zip(pairs, edited, _sets_of(edited, known.value)):
                row = {
                    "doc_id": d.doc_id,
                    "n_chars": len(d.text),
                    "edited_sha256": hashlib.sha256(text.encode()).hexdigest(),
                    "fingerprint": as_text(sets[k]),
                    "edited_fingerprint": as_text(other),
                    "near_edited": likeness(sets[k], other),
                    "near_next": likeness(sets[k], sets[k + 1]),
                }
                rows += [row] * d.copies
            yield pa.RecordBatch.from_pylist(rows, result)

    result = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]
    )
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    placed = _packed(docs, firsts).repartition("part")
    ordered = placed.sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "key")
    return ordered.mapInArrow(compare, schema)


def length_partition(size: int, percent: int) -> int:
    """The partition of a set of ``size`` signatures: similar sets are in the same or the next one."""
    part, bound = 0, 1
    while True:
        bound = bound * 100 // percent + 1
        if size < bound:
            return part
        part += 1


def spot_components(docs: DataFrame, anchors: np.ndarray | None = None, percent: int = 80) -> DataFrame:
    """(doc_id, n_spots, component_id, kept): near copies by 100 * |A & B| >= percent * |A | B|.

    Equal sets are one class. Sets meet in a bucket of a length partition and one of their rarest
    signatures: of a set of s, s - ceil(s * percent / 100) + 1 of them suffice. A set also looks into the next partition,
    where longer ones are. Buckets of any size are handled without comparing all their pairs.
    A document without a signature links with nothing, a NULL doc_id neither.
    """
    from orderlayers.llm import minhash

    if anchors is None:
        anchors = common_words(docs)
    shared = docs.sparkSession.sparkContext.broadcast(anchors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                sets = spot_sets(data, offsets, shared.value)
                sizes = np.array([len(s) for s in sets], np.int64)
                values = np.concatenate([*sets, np.empty(0, np.uint64)])
                marks = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(sizes),
                        pa.array([length_partition(s, percent) for s in sizes.tolist()], pa.int32()),
                        pa.array(minhash.set_hashes(values, sizes)[0].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(marks), pa.array(values.view(np.int64))),
                    ],
                    ["doc_id", "n_spots", "part", "cls", "shingles"],
                )

    schema = "doc_id long, n_spots long, part int, cls long, shingles array<long>"
    spotted = stored(id_and_text(docs).mapInArrow(work, schema), "spot-sets")
    named = spotted.filter("doc_id is not null and n_spots > 0")
    reps = stored(named.groupBy("cls").agg(F.min("doc_id").alias("rep")), "spot-reps")
    firsts = named.join(reps, "cls").filter("doc_id = rep")
    classes = stored(
        firsts.groupBy("cls").agg(F.first(F.struct("n_spots", "part", "shingles")).alias("c")).select("cls", "c.*"),
        "spot-classes",
    )
    each = classes.select("cls", F.col("n_spots").alias("size"), "part", F.explode("shingles").alias("spot"))
    often = stored(each.groupBy("spot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "spot-often")
    # Signatures of one class alone come first in the order and can meet nothing.
    ranked = each.join(often, "spot").groupBy("cls", "size", "part").agg(
        F.sort_array(F.collect_list(F.struct("n", "spot"))).alias("spots")
    )
    room = F.size("spots")
    prefix = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 - (F.col("size") - room)
    together = ranked.filter(prefix > 0).select(
        "cls", "size", room.cast("long").alias("room"),
        F.explode(F.slice("spots", 1, prefix.cast("int"))).alias("s"), "part",
    )
    together = together.select(
        "cls", "size", "room", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("p"), "s.spot"
    ).select(F.xxhash64("p", "spot").alias("bucket"), "cls", "size", "room")
    together = stored(together.distinct(), "spot-together")
    shared_buckets = together.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket")
    waiting = stored(together.join(shared_buckets, "bucket"), "spot-waiting")
    roots = minhash._linked(waiting, classes.select("cls", "shingles"), percent)
    if roots is None:
        groups = reps.select("cls", F.col("rep").alias("component_id"))
    else:
        rooted = stored(
            reps.join(roots, reps.cls == roots.node, "left").select("cls", "rep", F.coalesce("root", "cls").alias("root")),
            "spot-rooted",
        )
        least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        groups = rooted.join(least, "root").select("cls", "component_id")
    columns = ["doc_id", "n_spots", "component_id"]
    alone = spotted.filter("doc_id is null or n_spots = 0").withColumn("component_id", F.col("doc_id"))
    found = named.join(groups, "cls").select(*columns).unionByName(alone.select(*columns))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
