"""Helpers of the training-data operators: Arrow texts, vectorised word hashes, scratch tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlayers.session import scratch_path

#: Texts are worked on in slices of about this many bytes, so that the arrays of one slice
#: stay small however many rows an Arrow batch holds. One longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


#: Rows that a Python task gets at once, unless the session says otherwise: texts are long, and
#: a batch stands in the memory of the executor and of its worker several times.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1024

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is on the driver's path alone."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    root = Path(__file__).resolve().parents[2]
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if str(root) in map(os.path.abspath, places) or context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="orderlayers-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = f"{folder}/orderlayers.zip"
    with zipfile.ZipFile(package, "w") as out:
        for file in sorted((root / "orderlayers").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(package)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``frame`` written to the shared scratch folder and read again.

    The lineage ends here, a lost executor costs no recomputation of what came before, and
    the reread table has a known size for Spark's join choices.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def crc_of_id(column) -> F.Column:
    """crc32 of an id written as text; NULL ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def bit_filter(frame: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bits set at the low ``bits`` bits of all of a column of hashes, as 32-bit numbers.

    Spark packs them, so at most 2 ** (bits - 5) rows come to the driver, however many hashes.
    """
    packed = (
        frame.selectExpr(f"`{column}` & {(1 << bits) - 1} AS slot")
        .selectExpr("shiftright(slot, 5) AS word", "shiftleft(1L, CAST(slot & 31 AS INT)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    found = np.zeros(1 << (bits - 5), np.uint32)
    found[packed["word"].to_numpy()] = packed["bits"].to_numpy().astype(np.uint32)
    return found


def in_filter(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each (unsigned) hash is set."""
    slot = (hashes & np.uint64(32 * len(found) - 1)).astype(np.int64)
    return ((found[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a NULL is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``limit`` bytes each, or one longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_slices(batch: pa.RecordBatch, name: str = "text"):
    """(first row, last row, bytes, offsets) for each slice of a batch."""
    data, offsets = text_column(batch.column(batch.schema.get_field_index(name)))
    for first, last in slices(offsets):
        yield (
            first,
            last,
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )


def byte_table(is_member: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_member(b) for b in range(256)])


#: Words as maximal runs without ASCII white space.
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words as runs of ASCII letters, ASCII digits and anything beyond ASCII.
ALNUM = byte_table(
    lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER_VALUES = _BYTE_VALUES[_LOWER]


def word_bounds(data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """Starts and ends of the words of all rows, and each row's first word (rows + 1 marks)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = member[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) >= size:
        return _powers[0], _powers[1]
    tables = []
    for base in (_MULTIPLIER, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        tables.append(np.cumprod(steps, dtype=np.uint64))
    if size <= 2 * SLICE_BYTES:  # those of a very long text are not kept
        _powers[:] = tables
    return tables[0], tables[1]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on every bit of its input."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words with A-Z lower-cased: a polynomial by prefix sums."""
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LOWER_VALUES[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def gram_hashes(words: np.ndarray, first_word: np.ndarray, n: int):
    """Hashes of all n-word windows of all rows, and each row's first window.

    A row of fewer than n words has none here.
    """
    if len(words) < n:
        return np.empty(0, np.uint64), np.zeros(len(first_word), np.int64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = mix(total * _MULTIPLIER + words[k : len(words) - n + 1 + k])
    counts = np.maximum(np.diff(first_word) - n + 1, 0)
    marks = np.concatenate([[0], np.cumsum(counts)])
    index = np.arange(marks[-1]) - np.repeat(marks[:-1], counts)
    return total[index + np.repeat(first_word[:-1], counts)], marks


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns the operators read, whatever else the table holds."""
    known = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*known, *more)


def row_key() -> F.Column:
    """A row's document whatever its id: equal for rows that repeat both id and text."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def drop_rows(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is not among ``keys``, columns as they were."""
    gone = free_name(docs)
    return docs.join(keys.select(F.col(key).alias(gone)), row_key() == F.col(gone), "left_anti")


def free_name(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    taken = {name.lower() for name in docs.columns}
    return next(n for k in range(len(taken) + 1) if (n := f"extra_{k}") not in taken)


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row of those that repeat both id and text, columns as they were.

    Rows that repeat nothing are not moved; of the others a task sends one for each key.
    """
    key = free_name(docs)
    keyed = docs.withColumn(key, row_key())
    again = stored(keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "repeated-rows")
    alone = keyed.join(again, key, "left_anti").drop(key)
    names = [f"`{n}`" for n in docs.columns]
    one = keyed.join(again, key, "left_semi").groupBy(key).agg(F.first(F.struct(*names)).alias("row"))
    return alone.unionByName(one.select("row.*"))
