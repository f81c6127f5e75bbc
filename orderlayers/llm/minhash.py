"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct n-word shingles (words: runs without ASCII white space,
A-Z lower-cased). Each set is sketched by rounds of hashed bin placement: in round i every
element falls into one hashed bin with a hashed value ranked after all values of earlier
rounds, until each bin is full; from round t on, round t + j puts all elements into bin j, so
every bin fills. Bins grouped in bands name the candidates; links are confirmed on full sets.

Shingles that no other candidate holds bound every similarity of a set: with c the smaller count
of shared shingles, a pair reaches at most c / (|A| + |B| - c). Pairs below the threshold by
that bound are no candidates; this loses nothing and spares comparing all the strongly changed
copies of a text with each other.

Equal sets are one class. Only connectivity is asked for, so a bucket of m classes is not
expanded into its m * (m - 1) / 2 pairs: all members are compared with the bucket's most central
one, which connects most of them; then, where two components or more are left in a bucket, the
members outside of its largest component are compared with all others, block by block.

Defined results: documents with NULL or empty text or without a word have an empty set and
link with nothing. A NULL ``doc_id`` links with nothing and has a NULL component. Rows that
repeat a ``doc_id`` each get the component of their own text. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlayers.llm.common import (
    SPACED,
    bit_filter,
    drop_rows,
    first_of_each,
    gram_hashes,
    id_and_text,
    in_filter,
    mix,
    row_key,
    stored,
    text_slices,
    word_bounds,
    word_hashes,
)
from orderlayers.llm.components import connected_components

#: 28 bands of 5 bins: a pair at similarity 0.8 shares no band with probability 1.5e-5, a pair
#: at 0.05 shares one with probability 9e-6.
BANDS, ROWS = 28, 5
#: Members of a bucket that are compared at once, and shingles counted at once.
BLOCK, CHUNK = 512, 4096
#: Bits for each entry, and most bits (4 MB), of the filters that tell which documents' sets are
#: needed and which buckets are shared. With fewer than LEAST_BITS an entry, much passes by chance.
ENTRY_BITS, LEAST_BITS, FILTER_BITS = 64, 8, 25

_SEED = 0x2545F4914F6CDD1D


def _salt(k: int) -> np.uint64:
    return np.uint64(_SEED * k % (1 << 64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int):
    """Sorted distinct shingle hashes of each row, one after another, and each row's size.

    A row of fewer than n words has its whole word sequence as its only shingle.
    """
    starts, ends, first = word_bounds(data, offsets, SPACED)
    words = word_hashes(data, starts, ends)
    grams, marks = gram_hashes(words, first, n)
    parts, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for row in range(len(sizes)):
        if marks[row + 1] > marks[row]:
            part = np.unique(grams[marks[row] : marks[row + 1]])
        elif first[row + 1] > first[row]:
            whole = np.zeros(1, np.uint64)
            for word in words[first[row] : first[row + 1]]:
                whole = mix(whole * np.uint64(3) + word)
            part = mix(whole + np.uint64(first[row + 1] - first[row]))
        else:
            continue
        parts.append(part)
        sizes[row] = len(part)
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), sizes


def set_hashes(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit hashes of each set, equal for equal sets."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    sums = []
    for salt in (1, 2):
        total = np.zeros(len(sizes), np.uint64)
        np.add.at(total, owner, mix(values + _salt(1000 + salt)))
        sums.append(total)
    return sums


def sketches(values: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of each non-empty set: a (sets, bins) array of 64-bit values."""
    rows = len(sizes)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(rows * bins, empty, np.uint64)
    owner = np.repeat(np.arange(rows), sizes)
    for turn in range(2 * bins):
        hashed = mix(values + _salt(2 * turn + 1))
        if turn < bins:
            place = owner * bins + (hashed % np.uint64(bins)).astype(np.int64)
        else:
            place = owner * bins + (turn - bins)
        ranked = (np.uint64(turn) << np.uint64(54)) | (mix(hashed) >> np.uint64(10))
        np.minimum.at(sketch, place, ranked)
        open_rows = (sketch.reshape(rows, bins) == empty).any(axis=1) & (sizes > 0)
        if not open_rows.any():
            break
        going_on = open_rows[owner]
        values, owner = values[going_on], owner[going_on]
    return sketch.reshape(rows, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sketch), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sketch), band + 1, np.uint64)
        for k in range(rows):
            key = mix(key * np.uint64(31) + sketch[:, band * rows + k])
        keys[:, band] = key
    return keys


def _sketch_batches(n: int, bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, last, data, offsets in text_slices(batch):
                values, sizes = shingle_sets(data, offsets, n)
                sums = [pa.array(x.view(np.int64)) for x in set_hashes(values, sizes)]
                keys = band_keys(sketches(values, sizes, bands * rows), bands, rows)
                marks = np.arange(len(sizes) + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(sizes),
                        *sums,
                        batch.column(2).slice(first, last - first),
                        pa.ListArray.from_arrays(
                            pa.array(marks), pa.array(keys.ravel().view(np.int64))
                        ),
                    ],
                    ["doc_id", "n_shingles", "sum_a", "sum_b", "row_key", "bands"],
                )

    return work


def _set_batches(n: int, needed):
    """Sets of the rows whose ``spot`` is in the filter of needed documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = batch.column(2).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(in_filter(needed.value, spots)))
            for _, _, data, offsets in text_slices(batch):
                values, sizes = shingle_sets(data, offsets, n)
                marks = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(set_hashes(values, sizes)[0].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(marks), pa.array(values.view(np.int64))),
                    ],
                    ["cls", "shingles"],
                )

    return work


def _filter_of(entries: DataFrame, column: str) -> tuple[np.ndarray, bool]:
    """A filter of bounded size of a column of hashes, and whether little passes it by chance."""
    count = entries.count()
    bits = min(max((ENTRY_BITS * count).bit_length(), 16), FILTER_BITS)
    return bit_filter(entries, column, bits), LEAST_BITS * count <= 1 << bits


def _shared_batches(shared):
    """(cls, size, bucket) for those of the classes' buckets that are in the filter of shared ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column(2).flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), batch.column(2).value_lengths().to_numpy())
            keep = in_filter(shared.value, buckets.view(np.uint64))
            rows = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(buckets[keep])],
                ["cls", "size", "bucket"],
            )

    return work


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets have the asked similarity."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(left, "a").join(right, "b").filter(100 * common >= percent * union).select("a", "b")


def minhash_components(
    docs: DataFrame, n: int = 2, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row_key) for each row of ``docs`` (doc_id, text).

    Documents link when 100 * |A & B| >= percent * |A | B| on their n-word shingle sets.
    ``component_id`` is the smallest doc_id reachable by links, ``kept`` whether it is the
    document's own (true as well for a NULL id). ``row_key`` is the row whatever its id.
    """
    texts = id_and_text(docs, row_key().alias("row_key"))
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("sum_a", T.LongType()),
            T.StructField("sum_b", T.LongType()),
            T.StructField("row_key", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    sketched = stored(texts.mapInArrow(_sketch_batches(n, bands, rows), schema), "minhash-sketches")
    named = sketched.filter("doc_id is not null and n_shingles > 0")
    content = ["n_shingles", "sum_a", "sum_b"]
    classes = stored(named.groupBy(*content).agg(F.min("doc_id").alias("rep")), "minhash-classes")
    members = stored(
        named.join(classes, content).select(
            "doc_id", "n_shingles", "row_key", F.col("sum_a").alias("cls"),
            F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands"),
        ),
        "minhash-members",
    )
    in_bands = members.filter("bands is not null").select(
        "cls", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket")
    )
    shared = stored(
        in_bands.groupBy("bucket")
        .agg(F.min("cls").alias("low"), F.max("cls").alias("high"))
        .filter("low <> high")
        .select("bucket"),
        "minhash-buckets",
    )
    # Most buckets have one member: a filter keeps nearly all of those from being moved to the join.
    spark = docs.sparkSession
    inside = spark.sparkContext.broadcast(_filter_of(shared, "bucket")[0])
    likely = members.filter("bands is not null").select("cls", "n_shingles", "bands")
    likely = likely.mapInArrow(_shared_batches(inside), "cls long, size long, bucket long")
    together = stored(likely.join(shared, "bucket"), "minhash-together")
    needed = stored(
        together.select("cls").distinct().join(classes, F.col("cls") == F.col("sum_a")).select("cls", "rep"),
        "minhash-needed",
    )
    # Texts are not moved: a filter of bounded size tells which of them are needed. Sets of those
    # that pass it by chance, or repeat an id with another text, link nothing and lessen no one's
    # room; they are joined away only where the filter is too full to keep them few.
    spots, few = _filter_of(needed.select(F.xxhash64("rep").alias("spot")), "spot")
    passing = spark.sparkContext.broadcast(spots)
    sets = texts.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("spot"))
    sets = sets.mapInArrow(_set_batches(n, passing), "cls long, shingles array<long>")
    sets = stored(sets if few else sets.join(needed.select("cls"), "cls", "left_semi"), "minhash-sets")
    roots = _linked(stored(_with_room(together, sets, percent), "minhash-waiting"), sets, percent)
    columns = ["doc_id", "n_shingles", "component_id", "row_key"]
    alone = sketched.filter("doc_id is null or n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    named_by = _component_names(classes, roots)
    return (
        members.join(named_by, "cls").select(*columns)
        .unionByName(alone.select(*columns))
        .select(
            "doc_id", "n_shingles", "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row_key",
        )
    )


def keep_one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs`` (doc_id, text), columns as they were.

    Documents are compared whatever their ids, repeated and NULL ones included; the smallest
    doc_id stays, NULL ids come last. Texts without a word have no near copies.
    """
    keys = id_and_text(docs, row_key().alias("key"))
    found = minhash_components(keys.select(F.col("key").alias("doc_id"), "text"), n, percent)
    placed = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    named = stored(
        found.select(F.col("doc_id").alias("key"), "component_id").distinct()
        .join(keys.select("key", "doc_id").distinct(), "key")
        .select("component_id", placed.alias("place")),
        "minhash-places",
    )
    staying = named.groupBy("component_id").agg(F.min("place").alias("first"))
    gone = named.join(staying, "component_id").filter("place <> first").select(F.col("place.key").alias("key"))
    return first_of_each(drop_rows(docs, stored(gone, "minhash-gone"), "key"))


def _component_names(classes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(cls, component_id): the smallest document of all classes in the class's component."""
    own = classes.select(F.col("sum_a").alias("cls"), "rep")
    if roots is None:
        return own.withColumnRenamed("rep", "component_id")
    own = stored(
        own.join(roots, own.cls == roots.node, "left").select(
            "cls", "rep", F.coalesce("root", "cls").alias("root")
        ),
        "minhash-rooted",
    )
    names = stored(own.groupBy("root").agg(F.min("rep").alias("component_id")), "minhash-names")
    return stored(own.join(names, "root").select("cls", "component_id"), "minhash-named")


def _with_room(together: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Bucket members with ``room``, how many of their shingles another candidate has too.

    Members that are too much their own to link with anything are left out.
    """
    lonely = (
        sets.select("cls", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("cls").alias("cls"), F.max("cls").alias("other"))
        .filter("cls = other")
        .groupBy("cls")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    lonely = stored(lonely, "minhash-own-shingles")
    room = F.col("size") - F.coalesce("own", F.lit(0))
    return (
        together.join(lonely, "cls", "left")
        .select("bucket", "cls", "size", room.alias("room"))
        .filter(100 * F.col("room") >= percent * F.col("size"))
    )


def _linked(waiting: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, root) of all classes that confirmed links connect; None where there is no candidate."""
    if waiting.isEmpty():
        return None
    # First each bucket's most central member, the one that differs least from others, with all.
    order = F.struct((-F.col("room") / F.col("size")).alias("place"), "cls", "size", "room")
    pivots = stored(
        waiting.groupBy("bucket").agg(F.min(order).alias("p")).select(
            "bucket",
            F.col("p.cls").alias("pivot"),
            F.col("p.size").alias("pivot_size"),
            F.col("p.room").alias("pivot_room"),
        ),
        "minhash-pivots",
    )
    most = F.least("room", "pivot_room")
    pairs = (
        waiting.join(pivots, "bucket")
        .filter(
            (F.col("pivot") != F.col("cls"))
            & (100 * most >= percent * (F.col("size") + F.col("pivot_size") - most))
        )
        .select(F.least("pivot", "cls").alias("a"), F.greatest("pivot", "cls").alias("b"))
        .distinct()
    )
    links = stored(_confirmed(pairs, sets, percent), "minhash-links")
    roots = connected_components(links)
    rest = stored(_apart(waiting, pivots, roots), "minhash-apart")
    if rest.isEmpty():
        return roots
    more = stored(_across(rest, sets, percent), "minhash-links")
    return roots if more.isEmpty() else connected_components(links.union(more))


def _apart(waiting: DataFrame, pivots: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, but for the pivots, of buckets that still hold two components or more.

    ``major`` is the bucket's largest component, ``n`` and ``others`` count the bucket's members
    and those outside of it.
    """
    rest = waiting.join(
        pivots.select("bucket", F.col("pivot").alias("cls")), ["bucket", "cls"], "left_anti"
    )
    labelled = stored(
        rest.join(roots, rest.cls == roots.node, "left").select(
            "bucket", "cls", "size", F.coalesce("root", "cls").alias("component")
        ),
        "minhash-labelled",
    )
    counts = (
        labelled.groupBy("bucket", "component")
        .agg(F.count(F.lit(1)).alias("k"))
        .groupBy("bucket")
        .agg(F.sum("k").alias("n"), F.max(F.struct("k", "component")).alias("top"))
        .select("bucket", "n", F.col("top.component").alias("major"), (F.col("n") - F.col("top.k")).alias("others"))
        .filter("others > 0")
    )
    return labelled.join(stored(counts, "minhash-mixed"), "bucket")


def _across(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of each bucket: all its members against those outside ``major``.

    Both sides are cut into blocks, and each pair of blocks is one group of bounded size, in
    which a matrix product counts all common shingles. Groups return no pair but, for each
    member outside, one link to each component it is linked with.
    """
    parts, other_parts = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("others") / BLOCK)
    place = F.xxhash64("cls")
    cells = ["bucket", "part", "other_part"]
    columns = [*cells, "cls", "component"]
    whole = rest.withColumn("part", F.pmod(place, parts)).withColumn(
        "other_part", F.explode(F.sequence(F.lit(0).cast("long"), other_parts - 1))
    )
    outside = (
        rest.filter("component <> major")
        .withColumn("other_part", F.pmod(place, other_parts))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    )
    both = stored(
        whole.select(*columns, F.lit(False).alias("outside"))
        .unionByName(outside.select(*columns, F.lit(True).alias("outside"))),
        "minhash-cells",
    )
    filled = both.join(sets, "cls")
    return filled.groupBy(*cells).applyInArrow(_cell_links(percent), "a long, b long").distinct()


def _cell_links(percent: int):
    def work(cell: pa.Table) -> pa.Table:
        names, kinds = cell["cls"].to_numpy(), cell["component"].to_numpy()
        away = cell["outside"].to_numpy()
        lists = cell["shingles"].combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        values = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(names)), sizes)
        rows, columns = np.flatnonzero(away), np.flatnonzero(~away)
        shared, at = np.unique(values, return_inverse=True)
        # Only shingles on both sides can be common.
        useful = np.zeros((2, len(shared)), bool)
        useful[away[owner].astype(int), at] = True
        number = np.cumsum(useful.all(axis=0)) - 1
        keep = useful.all(axis=0)[at]
        owner, at = owner[keep], number[at[keep]]
        common = np.zeros((len(rows), len(columns)), np.float32)
        place = np.empty(len(names), np.int64)
        place[rows], place[columns] = np.arange(len(rows)), np.arange(len(columns))
        width = int(number[-1]) + 1 if len(number) else 0
        for low in range(0, width, CHUNK):
            here = (at >= low) & (at < low + CHUNK)
            own, col = owner[here], at[here] - low
            left = np.zeros((len(rows), min(CHUNK, width - low)), np.float32)
            right = np.zeros((len(columns), min(CHUNK, width - low)), np.float32)
            left[place[own[away[own]]], col[away[own]]] = 1
            right[place[own[~away[own]]], col[~away[own]]] = 1
            common += left @ right.T
        union = sizes[rows][:, None] + sizes[columns][None, :] - common
        linked = (100 * common.astype(np.float64) >= percent * union) & (kinds[rows][:, None] != kinds[columns][None, :])
        i, j = np.nonzero(linked)
        _, first = np.unique(np.stack([i, kinds[columns][j]]), axis=1, return_index=True)
        a, b = names[rows][i[first]], names[columns][j[first]]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return work
