"""Toxicity scores: subword embeddings averaged into a linear softmax, trained jointly in NumPy.

The bag of a text holds all its words and their character n-grams (with the blank before and after
a word as its edges, lower-cased), hashed into ``BUCKETS`` rows of one embedding table. The mean of
the rows goes through a linear softmax over the two classes. An unseen misspelling shares most of
its n-grams with the word it stands for, and so its vectors. The scores are calibrated on a fifth
of the training rows that the fit leaves out.

Only the fit is bounded: ``max_rows`` labelled rows, chosen by a hash of their id.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from creascope.llm.common import buffers, letters, slices, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS_BITS = 18
BUCKETS = 1 << BUCKETS_BITS
GRAMS = (3, 4, 5)
DIMENSIONS = 4
NEUTRAL = 60
STEP = 4.0
MAX_ROWS = 4000
THRESHOLD = 0.3


def held_out(id_col: str) -> Column:
    """The rows whose labels are never read."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


# -- bags of subwords -------------------------------------------------------------------------

def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, bounds per row) for the words and for each length of n-gram.

    A word that repeats the word before it is passed over, so "no no no no" weighs as "no".
    """
    hashed, row = words(data, offsets)
    fresh = np.ones(len(hashed), bool)
    fresh[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    buckets = (hashed[fresh] >> np.uint64(64 - BUCKETS_BITS)).astype(np.intp)
    yield buckets, np.searchsorted(row[fresh], np.arange(len(offsets)))
    text, bounds = letters(data, offsets)
    solid = text != 32
    new = solid.copy()
    new[1:] &= ~solid[:-1]
    counted = np.concatenate(([False], fresh))[np.cumsum(new)]  # per letter: its word counts
    gone = np.concatenate(([0], np.cumsum(~solid)))
    value, wide = text.astype(np.uint64), text.astype(np.uint64)
    for n in range(2, max(GRAMS) + 1):
        last = len(text) - n + 1
        if last < 1:
            return
        value = value[:last] * np.uint64(0x100000001B3) + wide[n - 1:]
        if n not in GRAMS:
            continue
        # blanks only at the ends, not at both
        inner = gone[n - 1:n - 1 + last] == gone[1:1 + last]
        where = np.flatnonzero(inner & (solid[:last] | solid[n - 1:]) & counted[1:1 + last])
        bucket = (value[where] ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (bucket ^ (bucket >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        yield (bucket >> np.uint64(64 - BUCKETS_BITS)).astype(np.intp), np.searchsorted(where, bounds)


def log_odds(weights: np.ndarray, bias: float, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bias plus the mean weight of a row's subwords; the bias alone for a row without words.

    ``NEUTRAL`` subwords of weight 0 join every bag, so a few words alone are no strong evidence.
    """
    total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for bucket, bounds in subwords(data, offsets):
        running = np.concatenate(([0.0], np.cumsum(weights[bucket], dtype=np.float64)))
        total += running[bounds[1:]] - running[bounds[:-1]]
        count += np.diff(bounds)
    return bias + total / (count + NEUTRAL)


# -- training ---------------------------------------------------------------------------------

def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, subwords, distinct, bag) per (id, label, text); the bag is packed by ``pack``."""
    for batch in batches:
        data, offsets = buffers(batch.column(2))
        lengths, sizes, packed = [], [], []
        for lo, hi in slices(offsets):
            kinds = list(subwords(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
            for i in range(hi - lo):
                all_of = np.concatenate([bucket[cut[i]:cut[i + 1]] for bucket, cut in kinds])
                distinct, times = np.unique(all_of, return_counts=True)
                lengths.append(len(all_of))
                sizes.append(len(distinct))
                packed.append(pack(distinct, times))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(lengths, pa.int64()), pa.array(sizes, pa.int64()),
            pa.array(packed, pa.binary())], names=["_id", "_label", "subwords", "distinct", "bag"])


def pack(distinct: np.ndarray, times: np.ndarray) -> bytes:
    """Steps between sorted buckets (32 bits) and their counts (16 bits, the largest for more), compressed."""
    steps = np.diff(distinct, prepend=0).astype(np.int32)
    return zlib.compress(steps.tobytes() + np.minimum(times, 65535).astype(np.uint16).tobytes(), 1)


def unpack(bags: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, their counts, bounds per text, subwords per text) of packed bags."""
    sizes = bags.column("distinct").to_numpy()
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    ids, counts = np.empty(bounds[-1], np.int32), np.empty(bounds[-1], np.uint16)
    for at, bag in enumerate(bags.column("bag")):
        raw, lo, hi = zlib.decompress(bag.as_buffer()), bounds[at], bounds[at + 1]
        np.cumsum(np.frombuffer(raw, np.int32, hi - lo), out=ids[lo:hi])
        counts[lo:hi] = np.frombuffer(raw, np.uint16, hi - lo, 4 * (hi - lo))
    return ids, counts, bounds, bags.column("subwords").to_numpy()


def train(packed: pa.Table, labels: np.ndarray, rounds: int = 6, batch_rows: int = 128, seed: int = 5) -> dict:
    """{"weights": one number per bucket, "bias", "slope", "shift"} from labelled bags.

    ``weights`` is the embedding table times the difference of the two softmax columns: the log-odds
    of a text are linear in its mean embedding. Subwords of a single training text are left out.
    """
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    if not len(labels) or labels.min() == labels.max():
        return {"weights": np.zeros(BUCKETS, np.float32), "bias": float(np.log(share / (1 - share))), "slope": 1.0, "shift": 0.0}
    ids, counts, bounds, lengths = unpack(packed)
    del packed
    seen = np.bincount(ids, minlength=BUCKETS) > 1
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    softmax = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    offset = np.array([0.0, np.log(share / (1 - share))])
    fit = (rng.random(len(labels)) < 0.8) & (np.diff(bounds) > 0)
    squares, squares_w, squares_b = np.full(BUCKETS, 1e-10, np.float32), 1e-10, np.full(2, 1e-10)
    change = np.empty((BUCKETS, DIMENSIONS), np.float32)
    for turn in range(rounds):
        chosen = rng.permutation(np.flatnonzero(fit))
        rate = 1.0 - 0.9 * turn / rounds
        for lo in range(0, len(chosen), batch_rows):
            batch = chosen[lo:lo + batch_rows]
            size = np.diff(bounds)[batch]
            cut = np.concatenate(([0], np.cumsum(size)))
            at = np.repeat(bounds[batch] - cut[:-1], size) + np.arange(cut[-1])
            bucket = ids[at]
            part = (counts[at] / np.repeat(lengths[batch] + NEUTRAL, size) * seen[bucket]).astype(np.float32)
            mean = np.add.reduceat(embedding[bucket] * part[:, None], cut[:-1], axis=0)
            logits = mean @ softmax + offset
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error /= len(batch)
            back, to_softmax = error @ softmax.T, mean.T @ error
            row = np.repeat(np.arange(len(batch)), size)
            for j in range(DIMENSIONS):
                change[:, j] = np.bincount(bucket, back[row, j] * part, minlength=BUCKETS)
            # one step size per bucket, from the squared gradients so far
            squares += (change ** 2).mean(axis=1)
            embedding -= (STEP * rate) * change / np.sqrt(squares)[:, None]
            squares_w += float((to_softmax ** 2).mean())
            softmax -= (0.1 * rate * to_softmax / np.sqrt(squares_w)).astype(np.float32)
            squares_b += error.sum(axis=0) ** 2
            offset -= 0.05 * rate * error.sum(axis=0) / np.sqrt(squares_b)
    weights = (embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32)
    # a bucket that no training text holds says nothing
    weights[~seen] = 0
    bias = float(offset[1] - offset[0])
    scores = np.array([
        bias + float(weights[ids[lo:hi]] @ counts[lo:hi].astype(np.float32)) / (n + NEUTRAL)
        for lo, hi, n in zip(bounds[:-1], bounds[1:], lengths)])
    apart = ~fit
    slope, shift = calibrate(scores[apart], labels[apart])
    return {"weights": weights, "bias": bias, "slope": slope, "shift": shift}


def calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic regression of the label on the score, by Newton steps."""
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    centre, spread = scores.mean(), scores.std() or 1.0
    x = np.stack(((scores - centre) / spread, np.ones(len(scores))), axis=1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        # a small ridge keeps separable scores finite
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2)
        beta -= np.linalg.solve(hessian, x.T @ (p - labels) + 0.5 * beta * [1, 0])
    slope = max(float(beta[0] / spread), 1e-6)
    return slope, float(beta[1] - beta[0] * centre / spread)


def fit_model(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", max_rows: int = MAX_ROWS,
) -> dict:
    """Train on at most ``max_rows`` labelled rows that are not held out.

    Rows without text, id or a label of 0 or 1 are left out; an id with several labels counts once.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).filter(
        F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(
        F.xxhash64("_id"), "_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = texts.join(F.broadcast(known), "_id").filter("_text is not null").groupBy("_id").agg(
        F.first("_label").alias("_label"), F.max("_text").alias("_text"))
    # the bags are made in the tasks: the driver never holds a text
    kind = texts.schema["_id"].dataType.simpleString()
    packed = rows.mapInArrow(
        bags, f"_id {kind}, _label int, subwords long, distinct long, bag binary").toArrow().sort_by("_id")
    labels_of = packed.column("_label").to_numpy().astype(np.int64)
    return train(packed.select(["subwords", "distinct", "bag"]), labels_of)


# -- scoring ----------------------------------------------------------------------------------

def score_batches(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        out = [
            log_odds(model["weights"], model["bias"], data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            for lo, hi in slices(offsets)]
        raw = np.concatenate(out) if out else np.zeros(0)
        score = 1 / (1 + np.exp(-np.clip(model["slope"] * raw + model["shift"], -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])


def keep_batches(batches: Iterator[pa.RecordBatch], model: dict, text_at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(text_at)], names=["a", "b"])
        for scored in score_batches(iter([pair]), model):
            yield batch.filter(pa.array(scored.column(1).to_numpy() < threshold))


def toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    NULL, empty and white texts get the score of an empty bag. A NULL id is returned as it is and
    counts as not held out. Repeated rows are scored each. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = texts.mapInArrow(lambda b: score_batches(b, model), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored at or above the threshold; all columns, one pass."""
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda b: keep_batches(b, model, at, threshold), docs.schema)
