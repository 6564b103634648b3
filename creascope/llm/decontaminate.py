"""Benchmark items inside documents: size-partitioned MinHash containment, verified exactly.

Containment of a short item in a long document corresponds to a small Jaccard similarity, the
smaller the longer the document. Documents therefore fall into size classes (powers of two of
their shingle count), and each class has its own number of MinHash coordinates,
``BINS_PER_SHINGLE`` times its upper size: coordinate j of a document is the smallest shingle
hash in the j-th part of the hash range (one-permutation hashing), coordinates are single-row
bands. A shingle that an item shares with a document survives as a coordinate with a chance of
at least ``(1 - exp(-x)) / x``, x = 1 / BINS_PER_SHINGLE, in every class alike.

An item is a candidate once one coordinate agrees; its full shingle set is then counted in the
document's full set. The items are the stated query set: they are taken in blocks of at most
``max_block`` shingles, and each block is compared with all documents in one scan without a shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from creascope.llm.common import SHINGLE_WORDS, buffers, shingles, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS_PER_SHINGLE = 8
MAX_BLOCK = 2_000_000

MATCH_SCHEMA = "doc_id long, item_id long, n_shared long, n_item long"


def item_shingles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for lo, hi in slices(offsets):
            hashed, bounds = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            sets = [np.unique(hashed[bounds[i]:bounds[i + 1]]) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary())], names=["item_id", "n_item", "shingles"])


class Block:
    """A block of items as sorted (shingle, item) rows."""

    def __init__(self, items: pa.Table):
        self.ids = items.column("item_id").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in items.column("shingles")]
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        every, self.item = every[order], owner[order]
        self.shingles, self.first = np.unique(every, return_index=True)
        self.last = np.append(self.first[1:], len(every))

    def items_of(self, found: np.ndarray) -> np.ndarray:
        """Item of every row whose shingle is in ``found``; an item once per shared shingle."""
        at = np.searchsorted(self.shingles, found)
        at = at[at < len(self.shingles)]
        at = at[np.isin(self.shingles[at], found)]
        size = self.last[at] - self.first[at]
        ends = np.cumsum(size)
        return self.item[np.repeat(self.first[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def coordinates(distinct: np.ndarray) -> np.ndarray:
    """MinHash coordinates of a sorted shingle set, with the bins of its size class."""
    bins = BINS_PER_SHINGLE << int(len(distinct) - 1).bit_length()
    place = distinct >> np.uint64(64 - int(bins - 1).bit_length())
    return distinct[np.diff(place, prepend=~place[:1]) != 0]


def contained(hashed: np.ndarray, block: Block, percent: int) -> list[tuple[int, int, int]]:
    """(item, shared shingles, item's shingles) for the items that one document contains."""
    distinct = np.unique(hashed)
    if not len(distinct) or not len(block.shingles):
        return []
    signature = coordinates(distinct)
    agreed = signature[np.isin(signature, block.shingles, assume_unique=True)]
    if not len(agreed):
        return []
    candidates = np.unique(block.items_of(agreed))
    shared = np.bincount(
        block.items_of(distinct[np.isin(distinct, block.shingles, assume_unique=True)]), minlength=len(block.ids))
    return [
        (int(block.ids[i]), int(shared[i]), int(block.sizes[i])) for i in candidates
        if 100 * shared[i] >= percent * block.sizes[i]]


def scan(hashed: np.ndarray, bounds: np.ndarray, block: Block, percent: int) -> Iterator[tuple[int, list]]:
    """(row, matches) for the rows with a match.

    Rows of a slice without any of the block's shingles are passed over at once: a coordinate is
    one of the row's shingles.
    """
    known = np.searchsorted(block.shingles, hashed)
    known[known == len(block.shingles)] = 0
    hit = np.flatnonzero(block.shingles[known] == hashed) if len(block.shingles) else []
    for row in np.unique(np.searchsorted(bounds, hit, side="right") - 1):
        found = contained(hashed[bounds[row]:bounds[row + 1]], block, percent)
        if found:
            yield int(row), found


def match_batches(batches: Iterator[pa.RecordBatch], block: Block, percent: int, k: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "n_shared", "n_item")])
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        ids, out = batch.column(0), []
        for lo, hi in slices(offsets):
            hashed, bounds = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            for row, found in scan(hashed, bounds, block, percent):
                out += [(ids[lo + row].as_py(), *match) for match in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in (zip(*out) if out else [[]] * 4)], schema=schema)


def clean_batches(batches: Iterator[pa.RecordBatch], block: Block, percent: int, k: int, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(text_at))
        clean = np.ones(batch.num_rows, bool)
        for lo, hi in slices(offsets):
            hashed, bounds = shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            for row, _ in scan(hashed, bounds, block, percent):
                clean[lo + row] = False
        yield batch.filter(pa.array(clean))


def blocks(items: DataFrame, id_col: str, text_col: str, k: int, max_block: int) -> Iterator[Block]:
    """The items in blocks of at most ``max_block`` shingles (one larger item is a block)."""
    texts = items.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    sets = texts.mapInArrow(lambda b: item_shingles(b, k), "item_id long, n_item long, shingles binary")
    sets = sets.filter("n_item > 0").dropDuplicates(["item_id", "shingles"])
    held, size = [], 0
    for row in sets.toLocalIterator():
        if held and size + row["n_item"] > max_block:
            yield Block(pa.Table.from_pylist(held))
            held, size = [], 0
        held.append({"item_id": row["item_id"], "shingles": bytes(row["shingles"])})
        size += row["n_item"]
    if held:
        yield Block(pa.Table.from_pylist(held))


def contaminations(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", percent: int = 80,
    k: int = SHINGLE_WORDS, max_block: int = MAX_BLOCK,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item): documents with at least ``percent`` of an item's shingles.

    Words and shingles as in the near-duplicate operator; an item of fewer than k words is one
    shingle and is found in documents of just these words. NULL, empty and white texts on
    either side match nothing; items with a NULL id are left out, documents with one are
    reported with it. Repeated documents are reported each, repeated items once. Other columns
    are not read. No match gives an empty table.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for block in blocks(items, item_col, item_text_col, k, max_block):
        matches = texts.mapInArrow(lambda b, block=block: match_batches(b, block, percent, k), MATCH_SCHEMA)
        found = matches if found is None else found.unionByName(matches)
    return docs.sparkSession.createDataFrame([], MATCH_SCHEMA) if found is None else found


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", percent: int = 80, k: int = SHINGLE_WORDS, max_block: int = MAX_BLOCK,
) -> DataFrame:
    """``docs`` without the documents that contain an item; all columns, one scan for all blocks."""
    at, schema = docs.columns.index(text_col), docs.schema
    for block in blocks(items, item_col, item_text_col, k, max_block):
        docs = docs.mapInArrow(lambda b, block=block: clean_batches(b, block, percent, k, at), schema)
    return docs
