"""Packing of documents into token sequences, in order, by dynamic programming.

Each task reads its share of the table in order as one stream of tokens and chooses where to cut
it.  Cuts at the end of a document are free, at the end of a sentence cost ``SENTENCE``, elsewhere
``FORCED``; every token of padding costs one.  With h(i) the cost of all up to candidate i plus its
position, h(j) is the least h(i) at most ``length`` before j, plus length, plus the cost of cutting at
j.  The least h of a sliding window comes from a monotone queue, so the best cuts take linear
time.  A task holds one chunk of tokens at a time: the best cuts of a chunk are fixed but for its last
window, which opens the next chunk.

No shuffle and no order across tasks: a sequence number is the number of the task and the place
in it, the same again when a lost task is run again.  Only the last sequence of each task may be short.
Null texts count as empty and hold the separator only; repeated and null doc_ids pass through.  A text of any length is
encoded whole, and so is a run of white space (see :mod:`findry.llm.tokens`); its ids are in memory at once.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm import tokens

LENGTH = 2048
SENTENCE = 4
FORCED = 64
CHUNK = 1 << 20
SEQUENCE_BITS = 32


def candidates(ids: np.ndarray, doc_ends: np.ndarray, length: int, ends: np.ndarray,
               spaces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, in order, from 0 to its end, and the cost of each."""
    n = len(ids)
    after = np.r_[spaces[ids[1:]], True] if n else np.zeros(0, bool)
    sentence = np.flatnonzero(ends[ids] & after) + 1
    places = np.unique(np.r_[0, sentence, doc_ends, n])
    step = max(1, length // 64)
    gaps = np.flatnonzero(np.diff(places) > step)
    more = [np.arange(places[i] + step, places[i + 1], step) for i in gaps]
    forced = np.concatenate(more) if more else np.zeros(0, np.int64)
    every = np.r_[places, forced]
    cost = np.r_[np.full(len(places), SENTENCE), np.full(len(forced), FORCED)]
    cost[:len(places)][np.isin(places, doc_ends)] = 0
    order = np.argsort(every, kind="stable")
    return every[order], cost[order]


def best_cuts(places: np.ndarray, cost: np.ndarray, length: int, final: bool) -> list[int]:
    """Ends of the windows of least total cost; without ``final`` the last window is left open."""
    at, price = places.tolist(), cost.tolist()
    last = len(at) - 1
    h, back = [0] * len(at), [0] * len(at)
    queue = deque([0])
    for j in range(1, last + 1):
        low = at[j] - length
        while at[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        back[j] = i
        value = h[j] = h[i] + length + price[j]
        while queue and h[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    j = last
    if not final:
        tail = [k for k in range(last, 0, -1) if at[k] > at[last] - length]
        j = min(tail, key=lambda k: (h[k] - at[k], -k))
    out = []
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


class Stream:
    """Tokens of the documents read so far that are not yet in a sequence."""

    def __init__(self, length: int, path: str, task: int):
        self.length, self.path = length, path
        self.next_sequence = task << SEQUENCE_BITS
        self.docs: list[tuple] = []  # (doc_id, ids still to place, tokens placed, tokens of all)
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.size += len(ids)

    def flush(self, final: bool) -> pa.RecordBatch:
        stream = np.concatenate([d[1] for d in self.docs])
        doc_ends = np.cumsum([len(d[1]) for d in self.docs])
        places, cost = candidates(stream, doc_ends, self.length, *tokens.boundaries(self.path))
        cuts = np.array(best_cuts(places, cost, self.length, final), np.int64)
        done = int(cuts[-1])
        ends = np.unique(np.r_[cuts, doc_ends[doc_ends <= done]])
        starts = np.r_[0, ends[:-1]]
        doc = np.searchsorted(doc_ends, starts, side="right")
        sequence = np.searchsorted(cuts, starts, side="right")
        before = np.r_[0, doc_ends[:-1]]
        placed = np.array([d[2] for d in self.docs], np.int64)
        out = pa.RecordBatch.from_arrays([
            pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            pa.array(starts - before[doc] + placed[doc]), pa.array(ends - starts),
            pa.array([stream[a:b].astype("<u4").tobytes() for a, b in zip(starts.tolist(), ends.tolist())],
                     pa.binary()),
            pa.array(np.array([d[3] for d in self.docs], np.int64)[doc]),
            pa.array(sequence + self.next_sequence), pa.array(starts - np.r_[0, cuts[:-1]][sequence]),
        ], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        self.next_sequence += len(cuts)
        left = int(np.searchsorted(doc_ends, done, side="right"))
        self.docs = self.docs[left:]
        if self.docs and done > before[left]:
            doc_id, ids, was, all_ = self.docs[0]
            used = done - int(before[left])
            self.docs[0] = (doc_id, ids[used:], was + used, all_)
        self.size = len(stream) - done
        return out


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None,
         separator: int = tokens.SEPARATOR) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds little-endian 32-bit numbers; a document is its tokens and then ``separator``.
    """

    def run(batches):
        path = tokenizer or tokens.public_path(tokens.BYTE_RANKS)
        encode = tokens.encoder(path).encode
        end = np.array([separator], np.uint32)
        stream = Stream(length, path, TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                stream.add(doc_id, np.concatenate([encode(text.as_py()), end]))
                if stream.size >= max(CHUNK, 16 * length):
                    yield stream.flush(False)
        if stream.size:
            yield stream.flush(True)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, "
             "sequence_id long, offset long")
