"""Shared pieces of the text operators: stored intermediate tables and word shingles.

Texts reach NumPy as the byte buffers of Arrow batches. A batch is worked through in slices of
about ``SLICE_BYTES``, so the temporary arrays stay small whatever the batch holds; a text that
is longer than a slice forms one of its own.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The Python workers need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 19
SHINGLE_WORDS = 5


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where it is unset, one in the warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage for good.

    What follows reads files, so a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{scratch_dir(spark)}/llm/{application}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- byte buffers -----------------------------------------------------------------------------

def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is empty, offsets start at 0."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = array.buffers()
    offsets = np.frombuffer(starts, np.int64)[array.offset:array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; at least one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


# -- hashing ----------------------------------------------------------------------------------

def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer of the public SplitMix64 generator, on 64-bit words."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BASE = 0x9D39247E33776D41  # odd, so that it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES) + 1
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, its row). Words are runs without the six ASCII white-space bytes."""
    return word_spans(data, offsets, lower)[:2]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its row, its first byte, the byte after it)."""
    if not len(data):
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    solid = ~_WHITE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[:len(data)], out=total[1:])
    hashed = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return hashed, np.searchsorted(offsets, start, side="right") - 1, start, end


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every k-word shingle, bounds per row), repeats included.

    A row with 1 to k-1 words has one shingle, its whole sequence; a row without words none.
    """
    hashed, row = words(data, offsets)
    rows = len(offsets) - 1
    counts = np.bincount(row, minlength=rows) if len(row) else np.zeros(rows, np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    have = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(have)))
    if not len(hashed):
        return np.zeros(0, np.uint64), bounds
    # position of each shingle's first word, and how many words it has
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], have)
    size = np.repeat(np.minimum(counts, k), have)
    padded = np.concatenate((hashed, np.zeros(k, np.uint64)))
    total = size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    step = np.uint64(0xE7037ED1A0B428DB)
    for j in range(k):
        total = total * step + np.where(j < size, padded[at + j], np.uint64(0))
    return mix(total), bounds


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with a blank before every row and after the last; row starts.

    Capitals of the Latin, Greek and Cyrillic main blocks are lowered; ASCII white space becomes
    a blank. Each row starts at its blank.
    """
    rows = len(offsets) - 1
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    first = data[at].astype(np.uint32)
    points = first.copy()
    size = np.diff(np.append(at, len(data)))
    for n, bits in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        pick = np.flatnonzero(size == n)
        if len(pick):
            value = first[pick] & bits
            for j in range(1, n):
                value = (value << 6) | (data[at[pick] + j] & 0x3F)
            points[pick] = value
    big = points >= 0x41
    capital = (points <= 0x5A) & big | (points >= 0xC0) & (points <= 0xDE) & (points != 0xD7)
    capital |= (points >= 0x391) & (points <= 0x3A9) | (points >= 0x410) & (points <= 0x42F)
    points[capital] += 32
    points[(points >= 9) & (points <= 13)] = 32
    bounds = np.searchsorted(at, offsets)
    out = np.full(len(points) + rows + 1, 32, np.uint32)
    out[np.arange(len(points)) + np.repeat(np.arange(1, rows + 1), np.diff(bounds))] = points
    return out, bounds + np.arange(rows + 1)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit words as Spark's signed longs, bit for bit."""
    return values.view(np.int64)
