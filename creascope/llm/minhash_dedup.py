"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard on full shingle sets.

One permutation scatters the shingles over a universe of ``2**UNIVERSE_BITS`` positions, a second
one gives the values; coordinate k of a signature is the minimum of the second permutation
shifted circularly by k. Documents that agree on all coordinates of a band share a bucket.

Documents with the same shingle set form one class from the start (grouped by a 128-bit digest
of the sorted set), so thousands of copies are one node. Pairs of classes from shared buckets are
tested on their full sets, ``100 * intersection >= percent * union``.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from creascope.llm.common import SHINGLE_WORDS, buffers, mix, shingles, signed, slices, stored
from creascope.llm.graph import components_of_buckets
from creascope.llm.prefilter import likely, only, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIVERSE_BITS = 18
BANDS, ROWS = 24, 5  # a pair at Jaccard 0.85 shares no band with a chance of (1 - 0.85**5)**24 < 1e-6
SEED = 20240601
PROFILE_BITS = 7

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, set_id binary, bands array<bigint>"


def permutations(bands: int = BANDS, rows: int = ROWS) -> tuple[np.uint64, np.ndarray]:
    """The scattering constant and the value permutation, continued past its end for the shifts."""
    rng = np.random.default_rng(SEED)
    scatter = rng.integers(1, 1 << 62, dtype=np.uint64)
    values = rng.permutation(1 << UNIVERSE_BITS).astype(np.int32)
    return scatter, np.concatenate((values, values[:bands * rows]))


def signatures(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, set_id, bands) per document; no bands without shingles."""
    scatter, values = permutations(bands, rows)
    universe = 1 << UNIVERSE_BITS
    for batch in batches:
        ids = batch.column(0)
        data, offsets = buffers(batch.column(1))
        for lo, hi in slices(offsets):
            part = data[offsets[lo]:offsets[hi]]
            hashed, bounds = shingles(part, offsets[lo:hi + 1] - offsets[lo], k)
            have = np.diff(bounds) > 0
            keys = np.zeros((hi - lo, bands), np.uint64)
            if have.any():
                starts = bounds[:-1][have]
                place = (mix(hashed ^ scatter) & np.uint64(universe - 1)).astype(np.intp)
                for band in range(bands):
                    key = np.full(len(starts), band + 1, np.uint64)
                    for shift in range(band * rows, (band + 1) * rows):
                        lowest = np.minimum.reduceat(values[shift:shift + universe][place], starts)
                        key = mix(key ^ lowest.astype(np.uint64))
                    keys[have, band] = key
            sizes, digests = [], []
            for i in range(hi - lo):
                distinct = np.unique(hashed[bounds[i]:bounds[i + 1]])
                sizes.append(len(distinct))
                digests.append(hashlib.blake2b(distinct.tobytes(), digest_size=16).digest())
            ends = np.concatenate(([0], np.cumsum(np.where(have, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(keys[have].reshape(-1))))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists],
                names=["doc_id", "n_shingles", "set_id", "bands"])


def shingle_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(node, shingles): the sorted distinct shingle hashes of a document as bytes."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for lo, hi in slices(offsets):
            hashed, bounds = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            sets = [np.unique(hashed[bounds[i]:bounds[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["node", "shingles"])


def shingle_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(node, shingle) for every distinct shingle of a document."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        ids = batch.column(0).to_numpy()
        for lo, hi in slices(offsets):
            hashed, bounds = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            sets = [np.unique(hashed[bounds[i]:bounds[i + 1]]) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(ids[lo:hi], [len(s) for s in sets])), pa.array(signed(np.concatenate(sets)))],
                names=["node", "shingle"])


def shingle_profiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(node, profile): how many distinct shingles of a document fall into each of the classes."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for lo, hi in slices(offsets):
            hashed, bounds = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            rows = [
                np.bincount((np.unique(hashed[bounds[i]:bounds[i + 1]]) >> np.uint64(64 - PROFILE_BITS)).astype(np.intp),
                            minlength=1 << PROFILE_BITS) for i in range(hi - lo)]
            flat = pa.array(np.concatenate(rows).astype(np.int32))
            ends = pa.array((np.arange(hi - lo + 1) << PROFILE_BITS).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(ends, flat)], names=["node", "profile"])


def similar_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose full sets pass the Jaccard test."""
    for batch in batches:
        keep = []
        for one, two in zip(batch.column(2), batch.column(3)):
            left, right = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
            both = np.concatenate((left, right))
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
    k: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``kept`` marks the row that has
    it. NULL and empty texts and texts of white space have no shingles and are linked with
    nothing. Texts of fewer than k words have one shingle, the whole sequence. A row with a NULL
    id is returned with a NULL component and ``kept`` true: it takes part in no link. Rows that
    repeat an id share its component. Other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed_docs = stored(texts.mapInArrow(lambda b: signatures(b, k, bands, rows), SIGNATURE_SCHEMA), "signatures")

    known = signed_docs.filter("doc_id is not null and n_shingles > 0")
    classes = stored(known.groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands")), "classes")
    members = known.select("doc_id", "set_id").join(classes.select("set_id", "node"), "set_id").select("doc_id", "node")

    buckets = classes.dropDuplicates(["node"]).select(
        "node", "size", F.lit(0).alias("bits"), F.explode("bands").alias("key"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        ends = stored(pairs.select(F.col("a").alias("doc_id")).distinct().unionByName(
            pairs.select(F.col("b").alias("doc_id")).distinct()).distinct(), "ends")
        # the join with the pairs leaves out the few sets too many
        involved = likely(texts, ends, "doc_id")
        full = stored(involved.mapInArrow(lambda b: shingle_sets(b, k), "node long, shingles binary"), "sets")
        full = full.dropDuplicates(["node"])
        left, right = full.toDF("a", "left_set"), full.toDF("b", "right_set")
        tested = pairs.join(left, "a").join(right, "b").select("a", "b", "left_set", "right_set")
        return tested.mapInArrow(lambda b: similar_pairs(b, percent), "a long, b long")

    def close(x: tuple[str, str, str], y: tuple[str, str, str]):
        # the intersection has at most what the smaller end shares with anyone
        most = F.least(x[1], y[1])
        return 100 * most >= percent * (F.col(x[0]) + F.col(y[0]) - most)

    def private(ends: DataFrame) -> DataFrame:
        ends = stored(ends.withColumnRenamed("node", "doc_id"), "ends")
        involved = stored(only(texts, ends, "doc_id"), "involved")
        pieces = involved.mapInArrow(lambda b: shingle_rows(b, k), "node long, shingle long")
        once = pieces.groupBy("shingle").agg(
            F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
        once = once.groupBy("node").agg(F.count("*").alias("private"))
        profiles = involved.mapInArrow(lambda b: shingle_profiles(b, k), "node long, profile array<int>")
        return stored(profiles.dropDuplicates(["node"]).join(once, "node", "left"), "private")

    def fits(x: tuple[str, str], y: tuple[str, str]):
        # shingles can only agree within their class
        most = F.aggregate(F.zip_with(x[1], y[1], lambda a, b: F.least(a, b)), F.lit(0), lambda total, n: total + n)
        return 100 * most >= percent * (F.col(x[0]) + F.col(y[0]) - most)

    linked = components_of_buckets(buckets, verify, close, private, fits)
    found = members.join(linked, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("component_id")).distinct()
    return signed_docs.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group; all columns, whatever their names.

    Rows with a NULL id and documents without words are untouched; an empty table stays empty. Rows that
    repeat an id stay or go together. Texts are read whole, however long.
    """
    dropped = stored(near_duplicates(docs, id_col, text_col, **options).filter("not kept").select(
        F.col("doc_id").cast(docs.schema[id_col].dataType)).distinct(), "dropped")
    return without(docs, dropped, id_col)
