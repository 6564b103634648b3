"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each scan partition fingerprints its texts (48 bits of the SHA-256 of the normalised text)
   in blocks. Per block, the distinct fingerprints of every owner (a range of fingerprints) are
   sorted and sent as one Golomb-Rice code of their gaps. Copies within a block are sent once,
   so a text that makes up a third of all rows weighs one fingerprint per block.
2. Each owner decodes what it received and answers every block with a bitmap: which of its
   fingerprints another block has, too.
3. A block knows its suspects from these bitmaps and its own repeats. Only suspects' texts are
   compared byte by byte, as keys of an aggregation with map-side combine.

Texts are equal when identical after lower-casing A-Z; NULL counts as empty.
"""

from __future__ import annotations

import hashlib
import math
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from creascope.llm.common import _LOWER, buffers, lower_ascii, stored
from creascope.llm.prefilter import only, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FINGERPRINT_BITS = 48
BLOCK_ROWS = 1 << 17
ROWS_PER_OWNER = 1 << 20

RECORD_SCHEMA = "kind int, doc_id long, fingerprint long, sha binary, block long, owner int, code binary"


# -- Golomb-Rice codes of sorted distinct numbers ---------------------------------------------

def encode(values: np.ndarray, base: int) -> bytes:
    """Gaps between ``base`` and the sorted ``values``: unary quotients, then the remainders."""
    gaps = np.diff(values, prepend=np.int64(base))
    mean = max(1.0, float(gaps.mean()))
    low = max(0, int(math.log2(mean * math.log(2)))) if mean > 2 else 0
    quotient = gaps >> low
    ends = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    remainder = ((gaps[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    head = np.packbits(unary).tobytes()
    return struct.pack("<IBI", len(values), low, len(head)) + head + np.packbits(remainder).tobytes()


def decode(code: bytes, base: int) -> np.ndarray:
    count, low, length = struct.unpack_from("<IBI", code)
    body = np.frombuffer(code, np.uint8, offset=9)
    ends = np.flatnonzero(np.unpackbits(body[:length]))[:count]
    quotient = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(body[length:])[:count * low].reshape(count, low).astype(np.int64)
    return base + np.cumsum((quotient << low) + (bits << np.arange(low)).sum(axis=1))


def owner_start(owner: int, owners: int) -> int:
    """Smallest fingerprint of an owner."""
    return -((-owner << FINGERPRINT_BITS) // owners)


def owner_slices(distinct: np.ndarray, owners: int) -> Iterator[tuple[int, int, int]]:
    """(owner, first, last) for the owners that a sorted array has fingerprints of."""
    owner_of = np.array([(int(v) * owners) >> FINGERPRINT_BITS for v in distinct], np.int64)
    firsts = np.flatnonzero(np.diff(owner_of, prepend=-1))
    for first, last in zip(firsts, [*firsts[1:], len(distinct)]):
        yield int(owner_of[first]), int(first), int(last)


# -- the three steps --------------------------------------------------------------------------

def fingerprint_rows(batches: Iterator[pa.RecordBatch], owners: int) -> Iterator[pa.RecordBatch]:
    """One row (kind 0) per document, and one (kind 1) per block and owner with the code."""
    schema = pa.schema([
        ("kind", pa.int32()), ("doc_id", pa.int64()), ("fingerprint", pa.int64()), ("sha", pa.binary()),
        ("block", pa.int64()), ("owner", pa.int32()), ("code", pa.binary())])
    block, held, rows = TaskContext.get().partitionId() << 24, [], 0

    def flush() -> pa.RecordBatch:
        distinct = np.unique(np.concatenate(held))
        sent = list(owner_slices(distinct, owners))
        codes = [encode(distinct[lo:hi], owner_start(owner, owners)) for owner, lo, hi in sent]
        n = len(sent)
        return pa.RecordBatch.from_arrays([
            pa.array([1] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.binary()), pa.array([block] * n, pa.int64()),
            pa.array([owner for owner, _, _ in sent], pa.int32()), pa.array(codes, pa.binary())], schema=schema)

    for batch in batches:
        data, offsets = buffers(batch.column(1))
        digests = [
            hashlib.sha256(_LOWER[data[offsets[i]:offsets[i + 1]]]).digest() for i in range(batch.num_rows)]
        if not digests:
            continue
        heads = np.frombuffer(b"".join(d[:8] for d in digests), ">u8")
        prints = (heads >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)
        held.append(prints)
        rows += len(prints)
        n = len(prints)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.zeros(n, np.int32)), batch.column(0), pa.array(prints), pa.array(digests, pa.binary()),
            pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
        if rows >= BLOCK_ROWS:
            yield flush()
            block, held, rows = block + 1, [], 0
    if held:
        yield flush()


def answer(codes: pa.Table, owners: int) -> pa.Table:
    """Bitmaps for the blocks that sent codes to one owner; blocks without a match get none."""
    owner = codes.column("owner")[0].as_py()
    base = owner_start(owner, owners)
    parts = [decode(code.as_py(), base) for code in codes.column("code")]
    everything = np.sort(np.concatenate(parts))
    shared = np.unique(everything[1:][everything[1:] == everything[:-1]])
    blocks, bitmaps = [], []
    for block, part in zip(codes.column("block").to_pylist(), parts):
        hit = np.isin(part, shared, assume_unique=True)
        if hit.any():
            blocks.append(block)
            bitmaps.append(np.packbits(hit).tobytes())
    return pa.table({
        "block": pa.array(blocks, pa.int64()), "owner": pa.array([owner] * len(blocks), pa.int32()),
        "bitmap": pa.array(bitmaps, pa.binary())})


def suspects_of_block(documents: pa.Table, bitmaps: pa.Table, owners: int) -> pa.Table:
    """Ids of a block's documents whose fingerprint occurs more than once anywhere."""
    prints = documents.column("fingerprint").to_numpy()
    if not len(prints):
        return pa.table({"doc_id": pa.array([], pa.int64())})
    distinct, inverse, counts = np.unique(prints, return_inverse=True, return_counts=True)
    suspect = counts > 1
    answers = dict(zip(bitmaps.column("owner").to_pylist(), bitmaps.column("bitmap").to_pylist()))
    if answers:
        for owner, lo, hi in owner_slices(distinct, owners):
            if owner in answers:
                bits = np.unpackbits(np.frombuffer(answers[owner], np.uint8))[:hi - lo]
                suspect[lo:hi] |= bits.astype(bool)
    return pa.table({"doc_id": documents.column("doc_id").filter(pa.array(suspect[inverse]))})


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Of equal texts the row with the largest id stays. NULL and empty texts are equal. A row with
    a NULL id counts in its group and stays only if no row of the group has an id. Rows that
    repeat both id and text share the mark. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(docs.count() / ROWS_PER_OWNER))
    records = stored(
        texts.mapInArrow(lambda b: fingerprint_rows(b, owners), RECORD_SCHEMA), "fingerprints", ["kind"])
    prints = records.filter("kind = 0").select("doc_id", "fingerprint", "sha", "block")
    codes = records.filter("kind = 1").select("block", "owner", "code")
    bitmaps = codes.groupBy("owner").applyInArrow(
        lambda table: answer(table, owners), "block long, owner int, bitmap binary")
    suspects = prints.select("doc_id", "fingerprint", "block").groupBy("block").cogroup(
        bitmaps.groupBy("block")).applyInArrow(
        lambda left, right: suspects_of_block(left, right, owners), "doc_id long")
    suspects = stored(suspects.distinct(), "suspects").withColumnRenamed("doc_id", "suspect")

    # whole texts as grouping keys: equal means equal in every byte
    involved = only(texts, suspects, "doc_id")
    groups = involved.groupBy(lower_ascii(F.col("text")).alias("normal")).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1").select(
        F.unhex(F.sha2(F.col("normal").cast("binary"), 256)).alias("sha"), "keep_id", "group_size")
    groups = stored(groups, "groups")
    return prints.join(groups, "sha", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns, whatever their names.

    Rows with a NULL id are left alone. Of rows that repeat both id and text one stays.
    """
    report = stored(exact_duplicates(docs, id_col, text_col).filter("group_size > 1 and doc_id is not null")
                    .select("doc_id", "kept"), "decisions")
    marks = report.groupBy(F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id")).agg(
        F.count("*").alias("n"), F.every("kept").alias("kept")).filter("n > 1 or not kept")
    marks = stored(marks, "marks")
    repeated = stored(marks.filter("kept").select("doc_id"), "repeated")
    return without(docs, marks.select("doc_id"), id_col).unionByName(
        only(docs, repeated, id_col).dropDuplicates([id_col]))
