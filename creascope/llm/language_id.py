"""Language identification with string kernels.

The kernel of two texts is the blended spectrum presence kernel: how many character n-grams of
length 1 to ``LONGEST`` both contain, normalised by the square roots of their own numbers. N-grams are
hashed to ``WIDTH`` places, so a text is a row of zeros and ones and a batch of texts a matrix X.
Nystroem landmarks L are training texts; with K = X L' normalised, one-versus-rest kernel ridge
regression on the Nystroem features K W^(-1/2) gives one score per language.

Everything after X is linear, so L' W^(-1/2) B is multiplied out once; a batch is scored by one
matrix product with a matrix of ``WIDTH`` rows and a column per language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from creascope.llm.common import buffers, letters, slices
from creascope.llm.toxicity import held_out

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 4
WIDTH_BITS = 15
WIDTH = 1 << WIDTH_BITS
LANDMARKS = 192
MAX_ROWS = 1500
RIDGE = 1e-2
ROWS_AT_ONCE = 64
UNKNOWN = "und"


def presence(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row, 0/1 matrix of the rows), at most ``ROWS_AT_ONCE`` rows at a time.

    Digits and ASCII punctuation count as blanks: they tell nothing about the language.
    """
    for lo in range(0, len(offsets) - 1, ROWS_AT_ONCE):
        hi = min(lo + ROWS_AT_ONCE, len(offsets) - 1)
        text, bounds = letters(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        plain = (text < 128) & ~((text >= 97) & (text <= 122))
        text = np.where(plain, np.uint32(32), text).astype(np.uint64)
        row = np.repeat(np.arange(hi - lo), np.diff(bounds))
        row = np.append(row, np.full(len(text) - len(row), hi - lo - 1)) << WIDTH_BITS
        matrix = np.zeros((hi - lo) << WIDTH_BITS, np.float32)
        blank = text == 32
        value = np.zeros(len(text), np.uint64)
        for n in range(1, LONGEST + 1):
            last = len(text) - n + 1
            if last < 1:
                break
            value = value[:last] * np.uint64(0x100000001B3) + text[n - 1:] + np.uint64(n)
            # n-grams of a single blank and those that span two blanks in a row say nothing
            keep = ~blank[:last] | ~blank[n - 1:]
            place = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - WIDTH_BITS)
            matrix[(row[:last] + place.astype(np.int64))[keep]] = 1.0
        yield lo, hi, matrix.reshape(hi - lo, WIDTH)


def lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a letter: an ASCII one at once, others as Unicode has it."""
    alpha = ((data | 0x20) >= 97) & ((data | 0x20) <= 122)
    sums = np.concatenate(([0], np.cumsum(alpha)))
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for row in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[row] = any(c.isalpha() for c in data[offsets[row]:offsets[row + 1]].tobytes().decode("utf-8", "replace"))
    return found


def normalised(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt(np.maximum(matrix.sum(axis=1, keepdims=True), 1))


def train(texts: pa.Array, languages: list[str], seed: int = 11) -> dict:
    """{"languages", "matrix" (WIDTH x languages), "bias"} by kernel ridge regression on landmarks."""
    names = sorted(set(languages))
    data, offsets = buffers(texts)
    if not names:
        return {"languages": [UNKNOWN], "matrix": np.zeros((WIDTH, 1), np.float32), "bias": np.zeros(1, np.float32)}
    wanted = np.array([names.index(x) for x in languages])
    rng = np.random.default_rng(seed)
    # the same number of landmarks per language, as far as it has texts
    share = max(1, LANDMARKS // len(names))
    chosen = np.sort(np.concatenate([
        rng.permutation(np.flatnonzero(wanted == i))[:share] for i in range(len(names))]))
    picked = np.zeros((len(chosen), WIDTH), np.float32)
    for lo, hi, matrix in presence(data, offsets):
        inside = (chosen >= lo) & (chosen < hi)
        picked[inside] = normalised(matrix[chosen[inside] - lo])
    kernel = np.concatenate([normalised(matrix) @ picked.T for _, _, matrix in presence(data, offsets)]).astype(np.float64)
    values, vectors = np.linalg.eigh((picked @ picked.T).astype(np.float64))
    good = values > 1e-6 * values.max() if values.max() > 0 else values > 0
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ whiten
    # every language weighs the same, however many texts it has
    weight = 1.0 / np.bincount(wanted, minlength=len(names))[wanted]
    target = np.where(wanted[:, None] == np.arange(len(names)), 1.0, -1.0)
    centre = np.average(features, axis=0, weights=weight)
    level = np.average(target, axis=0, weights=weight)
    shifted = (features - centre) * np.sqrt(weight)[:, None]
    gram = shifted.T @ shifted + RIDGE * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, shifted.T @ ((target - level) * np.sqrt(weight)[:, None]))
    return {
        "languages": names, "matrix": (picked.T.astype(np.float64) @ (whiten @ beta)).astype(np.float32),
        "bias": (level - centre @ beta).astype(np.float32)}


def fit_model(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS,
) -> dict:
    """Train on at most ``max_rows`` rows with text and language that are not held out.

    The rows are the first by a hash of the id within each language, in equal numbers; at most
    ``max_rows`` languages. Each text counts once.
    """
    known = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    known = known.filter(
        F.col("_id").isNotNull() & F.col("_lang").isNotNull() & (F.length(F.trim("_text")) > 0) & ~held_out("_id"))
    names = [r["_lang"] for r in known.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(max_rows).collect()]
    if not names:
        return train(pa.array([], pa.string()), [])
    each = max(1, max_rows // len(names))
    parts = None
    for name in names:
        first = known.filter(F.col("_lang") == name).select("_id", "_lang").orderBy(F.xxhash64("_id"), "_id").limit(each)
        parts = first if parts is None else parts.unionByName(first)
    chosen = parts.dropDuplicates(["_id"])
    rows = known.join(F.broadcast(chosen), ["_id", "_lang"]).groupBy("_id", "_lang").agg(
        F.max("_text").alias("_text")).toArrow().sort_by("_id")
    return train(rows.column("_text").combine_chunks(), rows.column("_lang").to_pylist())


def predict_batches(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    names = np.array(model["languages"], dtype=object)
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        known = lettered(data, offsets) if batch.num_rows else np.zeros(0, bool)
        best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
        for lo, hi in slices(offsets):
            part, cut = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            for first, last, matrix in presence(part, cut):
                size = np.sqrt(np.maximum(matrix.sum(axis=1, keepdims=True), 1))
                margin = (matrix @ model["matrix"]) / size + model["bias"]
                # a softmax of the margins, which aim at 1 for the language and -1 for the others
                odds = np.exp(3.0 * (margin - margin.max(axis=1, keepdims=True)))
                best[lo + first:lo + last] = margin.argmax(axis=1)
                score[lo + first:lo + last] = (odds / odds.sum(axis=1, keepdims=True)).max(axis=1)
        predicted = np.where(known, names[best], UNKNOWN)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(list(predicted), pa.string()), pa.array(np.where(known, score, 0.0))],
            names=["doc_id", "lang_pred", "score"])


def languages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    NULL texts and texts without a letter are ``und`` with score 0. A NULL id counts as not held
    out. Repeated rows are scored each. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = texts.mapInArrow(lambda b: predict_batches(b, model), "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
