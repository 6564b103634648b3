"""Cost-balanced packing of token sequences, inside the tasks that read the documents.

A sequence costs its tokens (linear layers) plus the squares of its pieces (attention inside a
piece). Every task packs windows of about ``WINDOW_TOKENS`` tokens: whole multiples of the capacity
are cut off first, each a sequence of its own; what is left of the documents goes, largest first, to
the sequence of lowest cost that still holds it. A piece that fits nowhere fills the cheapest sequence
with room and comes back with its rest. A window opens as many sequences as its tokens fill; the
rest below one capacity opens sequences of a power of two, which need no padding. So nothing is
padded, texts are never shuffled, and a task holds one window at a time.
"""

from __future__ import annotations

import heapq
import json
import sys
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
END_ID = 1
HIDDEN_SIZE = 1024  # of the model trained; a larger one makes the quadratic part matter less
WINDOW_TOKENS = 1 << 20
CHUNK_CHARS = 1 << 16
OUTPUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_capacity long")


# -- tokens -----------------------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Ids of the byte-level BPE in a ``tokenizers`` file.

    The merges run in ``tiktoken``, whose ids are the same and which is five times as fast; a stretch
    it cannot split (more than its regular expression can trace back) goes to ``tokenizers``.
    """

    def __init__(self, content: str):
        self.content, self.slow = content, None
        model = json.loads(content)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i
                 for token, i in model["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        parts = [self._chunk(text[a:b]) for a, b in safe_chunks(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def _chunk(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            self.slow = self.slow or tokenizers.Tokenizer.from_str(self.content)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def safe_chunks(text: str, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges that can be encoded apart: each starts at a blank between two non-blanks.

    No pre-token reaches across such a blank, so the ids are those of the whole text. A stretch
    without one stays whole.
    """
    first = 0
    while first < len(text):
        last = first + limit
        while last < len(text):
            last = text.find(" ", last)
            if last < 0 or last + 1 >= len(text):
                last = len(text)
            elif text[last - 1].isspace() or text[last + 1].isspace():
                last += 1
            else:
                break
        last = min(last, len(text))
        yield first, last
        first = last


_BUILT: dict[int, Tokens] = {}


def tokens_of(content: str) -> Tokens:
    """Built once per Python worker."""
    key = zlib.crc32(content.encode())
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Tokens(content)
    return _BUILT[key]


# -- packing ----------------------------------------------------------------------------------

def cost(tokens, hidden: int = HIDDEN_SIZE):
    """Cost of a piece in whole numbers: the linear layers of a block do 24 n h^2 operations, its
    attention 4 n^2 h, which is 6 h n + n^2 in units of 4 h."""
    return 6 * hidden * tokens + tokens * tokens


def room(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Capacities that hold ``tokens`` exactly: full ones, then falling powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(lengths: Sequence[int], capacity: int = CAPACITY, hidden: int = HIDDEN_SIZE) -> tuple[list[tuple], list[int]]:
    """([(document, start, length, sequence, offset)], [capacity of each sequence]).

    The sequences' capacities add up to the documents' tokens, so all of them end up full.
    """
    pieces, waiting, capacities = [], [], []
    for doc, length in enumerate(lengths):
        for start in range(0, length - capacity + 1, capacity):
            pieces.append((doc, start, capacity, len(capacities), 0))
            capacities.append(capacity)
        if length % capacity:
            waiting.append((-(length % capacity), doc, length - length % capacity))
    heapq.heapify(waiting)
    own = len(capacities)
    open_rooms = room(-sum(w[0] for w in waiting), capacity)
    capacities += open_rooms
    left = np.array(open_rooms, np.int64)
    spent = np.zeros(len(left), np.int64)
    most = np.iinfo(np.int64).max
    while waiting:
        minus, doc, start = heapq.heappop(waiting)
        want = -minus
        fits = left >= want
        if not fits.any():
            fits = left > 0
        chosen = int(np.where(fits, spent, most).argmin())
        length = min(want, int(left[chosen]))
        pieces.append((doc, start, length, own + chosen, open_rooms[chosen] - int(left[chosen])))
        left[chosen] -= length
        spent[chosen] += cost(length, hidden)
        if length < want:
            heapq.heappush(waiting, (length - want, doc, start + length))
    return pieces, capacities


def pack_batches(batches: Iterator[pa.RecordBatch], content, capacity: int, end_id: int, hidden: int,
                 window: int) -> Iterator[pa.RecordBatch]:
    machine = tokens_of(content.value)
    context = TaskContext.get()
    # like Spark's own increasing ids: the partition above, a running number below
    base = (context.partitionId() if context else 0) << 33
    names: list[int | None] = []
    ids: list[np.ndarray] = []
    held = made = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, made
        pieces, capacities = pack([len(x) for x in ids], capacity, hidden)
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces))
        crc = np.array([zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces], np.int64)
        columns = [
            pa.array(names, pa.int64()).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc),
            pa.array(np.array([len(x) for x in ids], np.int64)[doc]), pa.array(base + made + sequence),
            pa.array(offset), pa.array(np.array(capacities, np.int64)[sequence])]
        made += len(capacities)
        names.clear()
        ids.clear()
        held = 0
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUTPUT.split(", ")])

    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            names.append(name)
            ids.append(np.append(machine.ids(text.as_py() or ""), np.uint32(end_id)))
            held += len(ids[-1])
            if held >= window:
                yield flush()
    if ids:
        yield flush()


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID,
           hidden: int = HIDDEN_SIZE, window: int = WINDOW_TOKENS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Pieces of all documents: one row per piece with its place in a sequence.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_capacity): tokens
    ``start`` to ``start + length`` of the document lie at ``offset`` of the sequence. ``doc_tokens``
    counts the closing ``end_id``; a NULL or empty text is that id alone. Every token lies in one
    piece, every sequence is full to its capacity, which is ``capacity`` (a power of two) or, for at
    most log2(capacity) sequences a window, a smaller power of two.

    Repeated rows and NULL ids are packed as they are; an empty table gives no row. Ties (equal
    lengths, equal costs) go by order in the window. A text of any length is encoded in chunks; its
    ids are held by one task, 4 bytes each. Other columns are not read. Which documents share a
    sequence follows from how the files are split into tasks. The vocabulary is read on the driver
    and broadcast; its size is that of the file.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError(f"capacity has to be a power of two, not {capacity}")
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(
        lambda b: pack_batches(b, content, capacity, end_id, hidden, window), OUTPUT)
