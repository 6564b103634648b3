"""Semi- and anti-joins of wide rows with many ids, which shuffle few of the wide rows.

The ids are hashed into a bit set of 16 bits an id, at most ``2**MAX_BITS`` (8 MB), kept as a table
of 64-bit words: ``2**(MAX_BITS - 6)`` rows of two longs at most, whatever the number of ids, so it can be
broadcast. Every wide row looks its bit up inside the scan; about one in seventeen of the others passes by
chance. Where more ids come than the bit set can tell apart, more rows pass and the exact join
that follows does more of the work: results do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_BITS = 26
BITS_PER_ID = 16


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores in front until no frame has such a column."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def marked(rows: DataFrame, ids: DataFrame, on: str, mark: str) -> DataFrame:
    """``rows`` with a boolean column ``mark``: false only if ``on`` is not in the first column of ``ids``.

    ``ids`` is read twice and should be stored; it must have the type of ``on``. A NULL matches a NULL.
    """
    bits = 1 << min(max((BITS_PER_ID * ids.count()).bit_length(), 6), MAX_BITS)

    def place(column):
        return F.pmod(F.xxhash64(column), F.lit(bits).cast("long"))

    def bit(column):
        return F.call_function("shiftleft", F.lit(1).cast("long"), (column % 64).cast("int"))

    slot, word = free_name("_slot", rows), free_name("_word", rows)
    words = ids.select(place(F.col(ids.columns[0])).alias(slot)).groupBy(
        F.shiftright(slot, 6).alias("number")).agg(F.bit_or(bit(F.col(slot))).alias(word))
    placed = rows.withColumn(slot, place(F.col(f"`{on}`")))
    found = placed.join(F.broadcast(words), F.shiftright(placed[slot], 6) == words["number"], "left")
    has = F.coalesce(F.col(word).bitwiseAND(bit(F.col(slot))) != 0, F.lit(False))
    return found.withColumn(mark, has).drop(words["number"]).drop(slot, word)


def likely(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """The rows of ``rows`` whose ``on`` is in ``ids``, and a few others; no row is shuffled."""
    mark = free_name("_likely", rows)
    return marked(rows, ids, on, mark).filter(F.col(mark)).drop(mark)


def only(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Left semi join; a NULL matches a NULL."""
    few = likely(rows, ids, on)
    return few.join(ids, few[on].eqNullSafe(ids[ids.columns[0]]), "left_semi")


def without(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Left anti join; a NULL matches a NULL. Two scans of ``rows``, of which few rows are shuffled."""
    mark = free_name("_likely", rows)
    told = marked(rows, ids, on, mark)
    few = told.filter(F.col(mark)).drop(mark)
    return told.filter(~F.col(mark)).drop(mark).unionByName(
        few.join(ids, few[on].eqNullSafe(ids[ids.columns[0]]), "left_anti"))
