"""Token counts by a linear longest-match automaton over a public vocabulary.

A text is a sequence of words (runs without ASCII white space); each word is taken with a blank in
front and cut greedily into the longest vocabulary entries from the left. The automaton is the trie
of the entries with failure links: on a byte without an edge, the pieces that are then certain
are popped and the state moves on to the node of the remaining bytes. Only how many pieces a
failure pops is stored, so a word's length in tokens comes out in one pass over its bytes,
without any piece being built. A byte that starts no entry counts as one token.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from creascope.llm.common import buffers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
REMEMBERED_WORDS = 200_000  # per task; a full memory is emptied, counts do not depend on it


def read_vocabulary(path: str) -> list[bytes]:
    """Entries of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """Trie with failure links; ``popped[v]`` tokens are certain when node v has no next edge."""

    def __init__(self, entries: Iterable[bytes]):
        # every single byte is an entry, so a failure always ends at the root
        words = {*entries, *(bytes([b]) for b in range(256))} - {b""}
        self.edges: dict[int, int] = {}
        depth, parent, byte, final = [0], [0], [0], [False]
        for word in sorted(words):
            node = 0
            for value in word:
                key = node << 8 | value
                following = self.edges.get(key)
                if following is None:
                    following = self.edges[key] = len(depth)
                    depth.append(depth[node] + 1)
                    parent.append(node)
                    byte.append(value)
                    final.append(False)
                node = following
            final[node] = True
        size = len(depth)
        self.failure, self.popped = [-1] * size, [0] * size
        for node in sorted(range(1, size), key=depth.__getitem__):
            if final[node]:
                self.failure[node], self.popped[node] = 0, 1
                continue
            back, pieces = self.failure[parent[node]], self.popped[parent[node]]
            while back >= 0 and (back << 8 | byte[node]) not in self.edges:
                pieces += self.popped[back]
                back = self.failure[back]
            self.failure[node], self.popped[node] = self.edges[back << 8 | byte[node]], pieces

    def count(self, word: bytes) -> int:
        edges, failure, popped = self.edges, self.failure, self.popped
        node = tokens = 0
        for value in word:
            following = edges.get(node << 8 | value)
            while following is None:
                tokens += popped[node]
                node = failure[node]
                following = edges.get(node << 8 | value)
            node = following
        while node:
            tokens += popped[node]
            node = failure[node]
        return tokens


_BUILT: dict[str, Automaton] = {}


def automaton(path: str, entries: list[bytes]) -> Automaton:
    """Built once per Python worker."""
    if path not in _BUILT:
        _BUILT.clear()
        _BUILT[path] = Automaton(entries)
    return _BUILT[path]


def count_batches(batches: Iterator[pa.RecordBatch], path: str, entries) -> Iterator[pa.RecordBatch]:
    machine = automaton(path, entries.value)
    memory: dict[bytes, int] = {}
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        n_words, n_tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for row in range(batch.num_rows):
            # bytes.split() parts at the six ASCII white-space bytes
            parts = data[offsets[row]:offsets[row + 1]].tobytes().split()
            total = 0
            for word in parts:
                tokens = memory.get(word)
                if tokens is None:
                    if len(memory) >= REMEMBERED_WORDS:
                        memory.clear()
                    tokens = memory[word] = machine.count(b" " + word)
                total += tokens
            n_words[row], n_tokens[row] = len(parts), total
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words), pa.array(np.diff(offsets)), pa.array(n_tokens)],
            names=["doc_id", "n_words", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_bytes, n_tokens) for every row of ``docs``.

    The vocabulary is read on the driver and broadcast; its size is that of the file. NULL, empty and
    white texts have no tokens. Repeated rows and NULL ids are counted as they are. Other columns
    are not read.
    """
    entries = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(
        lambda b: count_batches(b, vocabulary, entries), "doc_id long, n_words long, n_bytes long, n_tokens long")
