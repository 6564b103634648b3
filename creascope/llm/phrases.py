"""Phrases that occur more often than their parts, counted over a prefix-free parse.

The texts are cut into pieces at punctuation and line breaks and these into chunks at content: a chunk
begins where the hash of four words meets a condition and ends with the four words that begin the
next one, so equal passages give equal chunks and neighbours overlap by four words. The distinct chunks
of a language are its dictionary, each with its frequency in the parse. A phrase of up to five words
belongs to the chunk in which it begins before the overlap, so it is counted once, weighted by the
chunk's frequency, however often the passage occurs.

Phrases are counted by length. A phrase can only be frequent if both phrases one word shorter
within it are; before counting a length, the tasks look these up in a bit set of ``FILTER_BITS`` bits.
A bit set by chance only lets a rare phrase through to the exact count.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from creascope.llm.common import buffers, mix, slices, stored, word_spans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_WORDS = 5
OVERLAP = MAX_WORDS - 1
TRIGGER = 16        # one window of four words in so many begins a chunk
MAX_CHUNK = 1024    # words; a passage without triggers is cut here
FILTER_BITS = 1 << 26
FILTER_BLOCK = 1 << 18
HELD_PHRASES = 400_000  # distinct phrases a task adds up before it passes them on
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- pieces and chunks ------------------------------------------------------------------------

def single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, bounds of the pieces in them, row of every piece): lower case, one blank between words."""
    solid = ~(_BREAKS[data] | _BLANKS[data])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64)
    breaks = np.concatenate(([0], np.cumsum(_BREAKS[data])))
    row = np.searchsorted(offsets, at, side="right") - 1
    opens = np.ones(len(at), bool)
    opens[1:] = (breaks[at[1:]] != breaks[at[:-1]]) | (row[1:] != row[:-1])
    # every word but a piece's first gets a blank in front
    word = np.cumsum(starts)[solid] - 1
    shift = np.cumsum(~opens)
    kept = _LOWER[data[solid]]
    out = np.full(len(kept) + int(shift[-1]), 32, np.uint8)
    out[np.arange(len(kept)) + shift[word]] = kept
    first = np.searchsorted(word, np.flatnonzero(opens)) + shift[opens]
    return out, np.append(first, len(out)), row[opens]


def window_hash(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, as far as there are so many."""
    n = max(len(hashed) - size + 1, 0)
    total = np.full(n, size, np.uint64) * np.uint64(0xA0761D6478BD642F)
    for j in range(size):
        total = total * np.uint64(0xE7037ED1A0B428DB) + hashed[j:n + j]
    return mix(total)


def chunk_bounds(hashed: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, words owned) of every chunk of every piece."""
    words = len(hashed)
    begins = np.ones(words, bool)
    begins[1:] = piece[1:] != piece[:-1]
    piece_at = np.flatnonzero(begins)
    piece_end = np.append(piece_at[1:], words)
    inside = np.zeros(words, bool)
    marks = np.flatnonzero(window_hash(hashed, OVERLAP) % np.uint64(TRIGGER) == 0)
    # the whole window lies in the piece and something of the piece follows it
    end_of = np.repeat(piece_end, piece_end - piece_at)
    inside[marks[marks + OVERLAP < end_of[marks]]] = True
    begins |= inside
    at = np.flatnonzero(begins)
    own = np.diff(np.append(at, words))
    if len(own) and own.max() > MAX_CHUNK:
        parts = -(-own // MAX_CHUNK)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(at, parts) + step * MAX_CHUNK
        own = np.diff(np.append(at, words))
    last = np.minimum(at + own + OVERLAP, end_of[at])
    return at, last, own


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Strings data[start:end]; the ranges may overlap."""
    size = end - start
    bounds = np.concatenate(([0], np.cumsum(size)))
    index = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], size)
    return pa.Array.from_buffers(pa.large_string(), len(start), [
        None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[index])]).cast(pa.string())


def chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        lang = codes.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        data, offsets = buffers(batch.column(1))
        for first, last in slices(offsets):
            part = data[offsets[first]:offsets[last]]
            text, pieces, row = single_spaced(part, offsets[first:last + 1] - offsets[first])
            if not len(text):
                continue
            hashed, piece, start, end = word_spans(text, pieces)
            at, upto, own = chunk_bounds(hashed, piece)
            language = lang[first + row[piece[at]]]
            # the passage is hashed by its words; equal ones of this slice travel once
            total = np.zeros(len(hashed) + 1, np.uint64)
            np.cumsum(hashed * _odd_powers(len(hashed)), out=total[1:])
            key = mix((total[upto] - total[at]) * _odd_inverses(len(hashed))[at] + own.astype(np.uint64)
                      + mix(language))
            _, where, count = np.unique(key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [codes.dictionary.take(pa.array(language[where].astype(np.int64))),
                 gather(text, start[at[where]], end[upto[where] - 1]),
                 pa.array(own[where].astype(np.int32)), pa.array(count)],
                names=["lang", "chunk", "own", "weight"])


_STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def _powers_of(name: str, base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(name, ())) < n + 1:
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS[name]


def _odd_powers(n: int) -> np.ndarray:
    return _powers_of("up", _STEP, n)[:n]


def _odd_inverses(n: int) -> np.ndarray:
    return _powers_of("down", pow(_STEP, -1, 1 << 64), n)[:n]


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, chunk, own, weight): the distinct chunks and how often each occurs in the parse.

    ``own`` is how many of the chunk's words are its own, the others begin the next chunk.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
    chunks = texts.mapInArrow(chunk_batches, "lang string, chunk string, own int, weight long")
    return chunks.groupBy("lang", "chunk", "own").agg(F.sum("weight").alias("weight"))


# -- counts -----------------------------------------------------------------------------------

class Totals:
    """Weights per phrase, added up in arrays; the phrases are told apart by 64-bit hashes."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
        self.size = 0

    def add(self, key, weight, lang: pa.Array, phrase: pa.Array) -> None:
        self.parts.append((key, weight, lang, phrase))
        self.size += len(key)

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys = np.concatenate([p[0] for p in self.parts])
            weights = np.concatenate([p[1] for p in self.parts])
            key, where, back = np.unique(keys, return_index=True, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, back, weights)
            pick = pa.array(where)
            self.parts = [(key, total, pa.concat_arrays([p[2] for p in self.parts]).take(pick),
                           pa.concat_arrays([p[3] for p in self.parts]).take(pick))]
            self.size = len(key)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for _, weight, lang, phrase in self.parts:
            yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(weight)], names=["lang", "phrase", "f"])
        self.parts, self.size = [], 0


def keyed(hashed: np.ndarray, language: np.ndarray) -> np.ndarray:
    return mix(hashed ^ language)


def lang_hash(names: pa.Array) -> np.ndarray:
    """A hash per language, the same in every task."""
    digests = [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in names.to_pylist()]
    return np.array([int.from_bytes(d, "little") for d in digests], np.uint64)


def count_batches(batches: Iterator[pa.RecordBatch], size: int, known) -> Iterator[pa.RecordBatch]:
    """Phrases of ``size`` words in chunks; ``known`` holds the frequent phrases one word shorter."""
    bits = None if known is None else np.frombuffer(known.value, np.uint8)
    totals, limit = Totals(), HELD_PHRASES
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        names = lang_hash(codes.dictionary)
        lang = codes.indices.to_numpy(zero_copy_only=False)
        data, offsets = buffers(batch.column(1))
        own_of = batch.column(2).to_numpy(zero_copy_only=False)
        weight_of = batch.column(3).to_numpy(zero_copy_only=False)
        for low, high in slices(offsets):
            text, bounds = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
            hashed, row, start, end = word_spans(text, bounds, lower=False)
            n = len(hashed) - size + 1
            if n <= 0:
                continue
            first_word = np.searchsorted(row, np.arange(high - low))
            inside = (np.arange(n) - first_word[row[:n]] < own_of[low + row[:n]]) & (row[size - 1:] == row[:n])
            language = names[lang[low + row]]
            if bits is not None:
                shorter = keyed(window_hash(hashed, size - 1), language[:n + 1])
                frequent = has(bits, shorter)
                inside &= frequent[:n] & frequent[1:]
            at = np.flatnonzero(inside)
            if not len(at):
                continue
            key = keyed(window_hash(hashed, size)[at], language[at])
            unique, where, back = np.unique(key, return_index=True, return_inverse=True)
            weight = np.zeros(len(unique), np.int64)
            np.add.at(weight, back, weight_of[low + row[at]])
            pick = at[where]
            totals.add(unique, weight, codes.dictionary.take(pa.array(lang[low + row[pick]])).cast(pa.string()),
                       gather(text, start[pick], end[pick + size - 1]))
            if totals.size > 2 * limit:
                totals.merge()
                if totals.size > limit:
                    yield from totals.flush()
    yield from totals.flush()


def has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = (key % np.uint64(len(bits) * 8)).astype(np.int64)
    return bits[place >> 3] >> (place & 7) & 1 == 1


def place_batches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        names = lang_hash(codes.dictionary)
        data, offsets = buffers(batch.column(1))
        hashed, row, _, _ = word_spans(data, offsets, lower=False)
        size = int(np.bincount(row).max()) if len(row) else 1
        first = np.searchsorted(row, np.arange(batch.num_rows))
        language = names[codes.indices.to_numpy(zero_copy_only=False)]
        place = keyed(window_hash(hashed, size)[first], language) % np.uint64(bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(place).astype(np.int64))], names=["place"])


def pack_block(table: pa.Table, block: int) -> pa.Table:
    marks = np.zeros(block, np.uint8)
    places = table.column("place").to_numpy()
    marks[places % block] = 1
    return pa.table({"block": pa.array([int(places[0]) // block], pa.int64()),
                     "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})


def bit_set(frequent: DataFrame, bits: int = FILTER_BITS, block: int = FILTER_BLOCK) -> bytearray:
    """Bit set of phrases of one length (lang, phrase): ``bits`` bits whatever their number.

    The bits are put together block by block in the tasks; the driver receives at most ``bits`` / 8
    bytes, 8 MB by default.
    """
    block = min(block, bits)
    places = frequent.select("lang", "phrase").mapInArrow(lambda b: place_batches(b, bits), "place long").distinct()
    packed = places.groupBy(F.floor(F.col("place") / block).alias("block")).applyInArrow(
        lambda table: pack_block(table, block), "block long, bits binary")
    out = bytearray(bits // 8)
    for row in packed.collect():
        out[row["block"] * block // 8:(row["block"] + 1) * block // 8] = row["bits"]
    return out


def frequent_phrases(parsed: DataFrame, least: int, longest: int = MAX_WORDS, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 1 to ``longest`` words that occur ``least`` times."""
    context = parsed.sparkSession.sparkContext
    found, known = [], None
    for size in range(1, longest + 1):
        if found:
            known = context.broadcast(bytes(bit_set(found[-1], bits)))
        counted = parsed.mapInArrow(
            lambda b, size=size, known=known: count_batches(b, size, known), "lang string, phrase string, f long")
        total = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        found.append(stored(total.withColumn("size", F.lit(size)), f"phrases{size}"))
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every


# -- scores -----------------------------------------------------------------------------------

# a share of n words by two counts: the products need up to 38 digits
SCORE = """cast((cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(18, 0)))
  div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as long)"""


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, bits: int = FILTER_BITS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to 5 words per language by their weakest cut.

    (lang, rank, phrase, a, l, r, n, score): ``a`` occurrences of the phrase, ``l`` and ``r`` of its two
    parts at the cut of lowest score, ``n`` words of the language, score floor(1000 a n / (l r)).
    Phrases that occur only within one longer frequent phrase are left out.

    Texts are lower-cased in A-Z, cut at ``.,;:!?`` and line breaks, words end at blanks and tabs.
    A NULL text is empty, a NULL language ``und``. Repeated rows count as often as they occur,
    whatever their ids; ties of score and ``a`` go by the phrase's bytes, ties of cuts to the first. A
    text without words adds nothing, an empty table gives no row. A very long text is cut into
    chunks like any other; columns other than the two named are not read.
    """
    parsed = stored(dictionary(docs, text_col, lang_col), "parse")
    every = frequent_phrases(parsed, least, bits=bits)
    total = parsed.groupBy("lang").agg(F.sum(F.col("weight") * F.col("own")).alias("n"))

    phrases = every.filter("size > 1")
    cuts = phrases.select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), F.col("size"),
    ).select("lang", "phrase", "a", "w", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    parts = every.select("lang", "phrase", "f")
    cuts = cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(
        parts.toDF("lang", "right", "r"), ["lang", "right"])
    # one row per language
    cuts = cuts.join(F.broadcast(total), "lang").withColumn("score", F.expr(SCORE))
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    # a phrase one word longer occurs as often: then the shorter one never stands alone
    longer = phrases.filter("size > 2").select("lang", "f", F.explode(F.array(
        F.regexp_replace("phrase", " [^ ]*$", ""), F.regexp_replace("phrase", "^[^ ]* ", ""))).alias("phrase"))
    covered = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    alone = weakest.join(covered, ["lang", "phrase"], "left").filter("most is null or most < a")
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    return alone.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"),
        F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
