"""Hard negatives from vectors, by matrix products in a residue number system.

Vectors are taken as integers, floor(256 x).  Their inner products are exact: for each of several small primes
the component matrices are reduced to residues around zero and multiplied in 32-bit floats, whose sums of ``DEPTH``
products stay below 2**24 and so lose nothing in any order of adding.  The products modulo the primes give the
signed score back by Chinese remaindering.  As many primes are taken as the largest norms of a pair of blocks ask for.

Anchors are written once as files; the table is scanned in place, twice, and each task streams the files over
a bounded part of its rows (:mod:`findry.sources.chunks`).  The first scan finds each anchor's positives, its best
rows of the same label.  They open a window of scores each, and the second scan finds the best rows of other labels in
every window.  A task passes on the first few rows of a window, ordered by score and id, which are then merged.

Rows with a null id, label or vector, or with null, NaN or infinite components, take no part; neither do rows whose scaled
vector has a squared norm of ``LARGEST`` or more, whose scores would not fit 64 bits.  Vectors of different lengths
have no score.  Repeated ids are rows of their own (an anchor's partners have other ids than its own), but an id
that is repeated asks once, with the least label and vector.  Extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from findry.functions import kernels
from findry.llm.scratch import Scratch
from findry.operators.topk import searchable
from findry.sources.chunks import HELD_BYTES, cut_into_chunks

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# The window of a negative score, in hundredths of the positive score.
LOW, HIGH = 30, 90
# Products added up in one 32-bit sum, and residues whose products so added stay below 2**24.
DEPTH = 64
LARGEST_RESIDUE = int((2 ** 24 / DEPTH) ** 0.5) - 1
LARGEST = 2.0 ** 56
# Rows and anchors that are multiplied at once, and bytes of a file of anchors.
ROW_BLOCK, ANCHOR_BLOCK = 2048, 512
ANCHOR_BYTES = 8 << 20


def primes_for(bound: float) -> list[int]:
    """Primes, largest first, whose product is beyond four times ``bound``."""
    out, product, p = [], 1, 2 * LARGEST_RESIDUE + 1
    while product <= 4 * bound + 4:
        if all(p % d for d in range(2, int(p ** 0.5) + 1)):
            out.append(p)
            product *= p
        p -= 1
    return out


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Components modulo ``p``, around zero, as 32-bit floats."""
    r = np.mod(matrix, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _norm(matrix: np.ndarray) -> float:
    return float(np.sqrt((matrix * matrix).sum(axis=1).max(initial=0.0)))


class Rows:
    """Integer vectors as doubles, with their residue matrices made as they are needed."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.norm, self.made = matrix, _norm(matrix), {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.made:
            self.made[p] = residues(self.matrix, p)
        return self.made[p]


def products(left: Rows, right: Rows) -> np.ndarray:
    """All inner products, exact, as 64-bit integers."""
    primes = primes_for(left.norm * right.norm * (1 + 1e-9) + 1)
    dim = left.matrix.shape[1]
    value, radix, near = None, 1, None
    for p in primes:
        a, b = left.modulo(p), right.modulo(p)
        total = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, dim, DEPTH):
            total += (a[:, at:at + DEPTH] @ b[:, at:at + DEPTH].T).astype(np.int64)
        total %= p
        if value is None:
            value = near = total
        else:
            # Garner's step: the digit that makes the value right modulo p as well.
            digit = (total - value % p) * pow(radix % p, -1, p) % p
            near = value + float(radix) * digit
            value = value + (np.uint64(radix) * digit.astype(np.uint64)).view(np.int64)
        radix *= p
    # Scores lie in the lowest or highest quarter of the range; only the last step can pass 64 bits,
    # and taking the range off brings it back.
    return value - np.where(near > radix / 2, np.array(radix % 2 ** 64, np.uint64).view(np.int64), 0)


class Best:
    """The first ``k`` rows of every slot, by falling score and rising id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.bound = np.full(slots, np.iinfo(np.int64).min)

    def offer(self, slot, score, ids) -> None:
        good = score >= self.bound[slot]
        slot, score, ids = (np.concatenate(x) for x in zip(
            (self.slot, self.score, self.id), (slot[good], score[good], ids[good])))
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order = order[place < self.k]
        slot, place = slot[place < self.k], place[place < self.k]
        self.slot, self.score, self.id = slot, score[order], ids[order]
        full = place == self.k - 1
        self.bound[slot[full]] = self.score[full]


def _first(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the allowed scores of each line that are as high as its k-th best; ties stay."""
    if scores.shape[1] > k:
        low = np.iinfo(np.int64).min
        held = np.where(allowed, scores, low)
        least = -np.partition(-held, k - 1, axis=1)[:, k - 1:k] if held.size else held[:, :1]
        return np.nonzero(allowed & (scores >= least))
    return np.nonzero(allowed)


def _usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, scaled and floored."""
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & searchable("embedding")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    # Floor would saturate beyond 64 bits; such rows are left out by their unrounded norm as well.
    norm = F.aggregate("embedding", F.lit(0.0),
                       lambda s, x: s + x.cast("double") * SCALE * x.cast("double") * SCALE)
    exact = F.aggregate(whole, F.lit(0.0), lambda s, x: s + x * x)
    return (vectors.where(good).where(norm < 2 * LARGEST)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    whole.alias("vector"), exact.alias("norm"))
            .where(F.col("norm") < LARGEST).drop("norm"))


def _merged(partials: DataFrame, key: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key with their ``rank``; first within groups of tasks, then over all."""
    fan = int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("id")]
    some = Window.partitionBy(*key, F.pmod("part", F.lit(fan))).orderBy(*order)
    every = Window.partitionBy(*key).orderBy(*order)
    return (partials.withColumn("some", F.row_number().over(some)).where(F.col("some") <= k)
            .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k)
            .drop("some", "part"))


def _by_length(column, block: int) -> list[tuple[int, np.ndarray, Rows]]:
    """``(vector length, places, vectors)`` in blocks of one length."""
    column = kernels.one_array(column)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for size in np.unique(sizes).tolist():
        every = np.flatnonzero(sizes == size)
        for at in np.split(every, range(block, len(every), block)):
            matrix = kernels.to_matrix(column.take(pa.array(at)), size) if size else np.zeros((len(at), 0))
            out.append((size, at, Rows(matrix)))
    return out


def _scan(anchors, rows: DataFrame, k: int, slots: int, choose, held_bytes: int) -> DataFrame:
    """``anchor_id, slot, id, score, part``: the best rows a task has for every slot of every anchor.

    ``choose(lines, chunk, row_labels, scores)`` gives, for each slot, which scores may count.
    """

    def start(held):
        part = TaskContext.get().partitionId()
        ids, labels = held.column("vec_id").to_numpy(), held.column("label").to_numpy()
        blocks = _by_length(held.column("vector"), ROW_BLOCK)

        def score(chunk):
            asked = chunk.column("vec_id").to_numpy()
            best = Best(len(asked) * slots, k)
            for size, lines, wanted in _by_length(chunk.column("vector"), ANCHOR_BLOCK):
                for of, at, found in blocks:
                    if of != size:
                        continue
                    scores = products(wanted, found)
                    for slot, allowed in enumerate(choose(lines, chunk, labels[at], scores)):
                        allowed &= ids[at][None, :] != asked[lines][:, None]
                        a, r = _first(scores, allowed, k)
                        best.offer(lines[a] * slots + slot, scores[a, r], ids[at][r])
            n = len(best.slot)
            return pa.record_batch({
                "anchor_id": pa.array(asked[best.slot // slots]), "slot": pa.array(best.slot % slots + 1),
                "id": pa.array(best.id), "score": pa.array(best.score),
                "part": pa.array(np.full(n, part, np.int64))})

        return score

    return anchors.scan(rows, "vector", start, "anchor_id long, slot long, id long, score long, part long",
                        held_bytes)


def mine(vectors: DataFrame, asked, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, held_bytes: int = HELD_BYTES,
         anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` is ``vec_id, label, embedding``; ``asked`` is a condition that anchors meet.  The positives of an
    anchor are its first rows of the same label, the negatives of a positive the first rows of other labels whose
    score lies from ``low`` to ``high`` hundredths of the positive score; first by score, then by id.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = _usable(vectors)
    anchors = scratch.keep(rows.where(asked).groupBy("vec_id").agg(
        F.min(F.struct("label", "vector")).alias("least")).select("vec_id", "least.*"), "anchors")
    n, dim = anchors.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    per_chunk = max(1, anchor_bytes // (8 * dim + 64))

    def same(lines, chunk, row_labels, scores):
        return [chunk.column("label").to_numpy()[lines][:, None] == row_labels[None, :]]

    found = _merged(_scan(cut_into_chunks(anchors, n, per_chunk), rows, positives, 1, same, held_bytes),
                    ["anchor_id"], positives)
    found = scratch.keep(found.select("anchor_id", F.col("rank").cast("long").alias("slot"),
                                      F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                         "positives")
    # Windows as whole numbers: from the first at or above the lower to the last at or below the upper end.
    windows = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        "slot", F.expr(f"-((-({low} * positive_score) - pmod(-({low} * positive_score), 100)) div 100)").alias("least"),
        F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100").alias("most")))).alias("w"))
    ready = scratch.keep(anchors.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(
        "vec_id", "label", "vector", F.col("w.least").alias("least"), F.col("w.most").alias("most")), "windows")

    def others(lines, chunk, row_labels, scores):
        unlike = chunk.column("label").to_numpy()[lines][:, None] != row_labels[None, :]
        least, most = chunk.column("least").take(pa.array(lines)), chunk.column("most").take(pa.array(lines))
        least, most = kernels.one_array(least), kernels.one_array(most)
        sizes = least.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        least, most = least.flatten().to_numpy(), most.flatten().to_numpy()
        for slot in range(positives):
            has = sizes > slot
            at = np.where(has, starts + slot, 0)
            yield (unlike & has[:, None] & (scores >= least[at][:, None]) & (scores <= most[at][:, None]))

    mined = _merged(_scan(cut_into_chunks(ready, n, per_chunk), rows, negatives, positives, others, held_bytes),
                    ["anchor_id", "slot"], negatives)
    return mined.join(found, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
