"""Alignment of two tokenizers over the same bytes, by lockstep vectorised merging.

Both tokenizers cut the bytes of space + text.  Merging their cuts is a walk of two pointers: the tokens
under the pointers overlap and are linked; whichever ends first is passed, and where both end the
bytes are cut into groups.  All documents of a batch walk at once: one vector holds the pointer pair of
every walker, each step links all pairs, compares all ends, records the common ones and advances, and
walkers that are done are taken out.  Every byte lies in one token of each side, so a walk can start at any byte;
a long document is given to several walkers, ``STRETCH`` bytes each, and takes no more steps than a short one.

:func:`align` gives the groups and the linked id pairs of every document, without a shuffle.
:func:`count_links` counts in how many documents of the table each id pair is linked and sums these counts
over the links of each document.  Counts are added up inside tasks before they are shuffled.  The ``HEAVY`` most
frequent pairs are broadcast; links of all others are looked up by a join on the pair, which has no hot keys,
as frequent pairs are not in it.  Both ways give the same numbers.

A text that is null, empty, or not given back byte by byte by both tokenizers has no tokens.  Repeated and null
doc_ids are rows of their own, other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm import tokens
from findry.llm.scratch import Scratch

PIECES = "piece_bpe_32k.model"
# Bytes one walker merges, and bytes of text that are merged at once.
STRETCH = 2048
BATCH_BYTES = 4 << 20
# Id pairs whose counts are broadcast (16 bytes each), and distinct pairs a task adds up before passing them on.
HEAVY = 2_000_000
HELD_PAIRS = 1_000_000
ROW_BITS = 40
# A pair is a * 2**32 + b.
PAIR_BITS = 32


class ByteSide:
    """Ids by a rank file of byte-level tokens, special strings as plain text."""

    def __init__(self, path: str):
        own = tokens.encoder(path)
        self.encode_one = own.encode_plain
        self.bytes = [own.core.decode_single_token_bytes(i) for i in range(own.core.n_vocab)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode_one(" " + text) for text in texts]


class PieceSide:
    """Ids by a sentencepiece model that puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode("utf-8", "surrogatepass")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(texts, num_threads=1)]


def merge(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray,
          stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (token of A, token of B) and cuts of texts that lie one after another.

    ``ends_*`` are the byte ends of all tokens, ``starts`` the byte starts of the texts; both sides end together
    at the end of every text.  Links come in no certain order, cuts ascend.
    """
    if not len(ends_a):
        none = np.zeros(0, np.int64)
        return none, none, none
    last = int(ends_a[-1])
    sizes = np.diff(np.r_[starts, last])
    walkers = -(-sizes // stretch)
    first = np.repeat(starts, walkers)
    place = np.arange(walkers.sum()) - np.repeat(np.cumsum(walkers) - walkers, walkers)
    at = first + place * stretch
    a, b = np.searchsorted(ends_a, at, side="right"), np.searchsorted(ends_b, at, side="right")
    stop_a, stop_b = np.r_[a[1:], len(ends_a)], np.r_[b[1:], len(ends_b)]
    ahead = (a != stop_a) | (b != stop_b)  # long tokens may hold the starts of several walkers
    a, b, stop_a, stop_b = a[ahead], b[ahead], stop_a[ahead], stop_b[ahead]
    links_a, links_b, cuts = [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        cuts.append(end_a[end_a == end_b])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        ahead = (a != stop_a) | (b != stop_b)
        if not ahead.all():
            a, b, stop_a, stop_b = a[ahead], b[ahead], stop_a[ahead], stop_b[ahead]
    return np.concatenate(links_a), np.concatenate(links_b), np.sort(np.concatenate(cuts))


@dataclass
class Aligned:
    """The alignment of a batch: by document, ids, groups and distinct linked id pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: list[np.ndarray]  # pair, ascending
    times: list[np.ndarray]  # links of that pair in the document


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.width_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.width_b = np.array([len(x) for x in self.b.bytes], np.int64)
        # What is written after a token: a comma inside its group, then the bar and the semicolon.
        self.written = [f"{i}{mark}" for n, marks in ((len(self.a.bytes), ",|"), (len(self.b.bytes), ",;"))
                        for mark in marks for i in range(n)]

    def _tokens(self, texts: list[str | None]) -> tuple[list, list]:
        none = np.zeros(0, np.uint32)
        known = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in known]
        out_a, out_b = [none] * len(texts), [none] * len(texts)
        get_a, get_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        for i, text, a, b in zip(known, given, self.a.encode(given), self.b.encode(given)):
            data = b" " + text.encode("utf-8", "surrogatepass")
            if b"".join(map(get_a, a.tolist())) == data and b"".join(map(get_b, b.tolist())) == data:
                out_a[i], out_b[i] = a, b
        return out_a, out_b

    def align(self, texts: list[str | None]) -> Aligned:
        by_a, by_b = self._tokens(texts)
        n_a, n_b = (np.array([len(x) for x in by], np.int64) for by in (by_a, by_b))
        ids_a, ids_b = (np.concatenate(by).astype(np.int64) for by in (by_a, by_b))
        ends_a, ends_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        stops_a, stops_b = np.cumsum(n_a), np.cumsum(n_b)
        bounds = np.r_[0, ends_a][stops_a]  # byte ends of the documents
        full = n_a > 0
        starts = np.r_[0, bounds[:-1]][full]
        link_a, link_b, cuts = merge(ends_a, ends_b, starts)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        n_groups = np.diff(np.r_[0, np.searchsorted(cuts, bounds, side="right")])
        doc = np.repeat(np.arange(len(texts)), n_a)[link_a]
        n_links = np.bincount(doc, minlength=len(texts))
        pairs, times = self._pairs(doc, ids_a[link_a], ids_b[link_b], len(texts))
        groups = self._groups(ids_a, ids_b, ends_a, ends_b, group_a, group_b, cuts, stops_a + stops_b)
        return Aligned(n_a, n_b, n_groups, n_links, groups, pairs, times)

    def _pairs(self, doc, a, b, n):
        width = len(self.b.bytes)
        every, times = np.unique((doc * len(self.a.bytes) + a) * width + b, return_counts=True)
        pair = every % (len(self.a.bytes) * width)
        pair = (pair // width << PAIR_BITS) | pair % width
        at = np.searchsorted(every, np.arange(1, n) * len(self.a.bytes) * width)
        return np.split(pair, at), np.split(times, at)

    def _groups(self, ids_a, ids_b, ends_a, ends_b, group_a, group_b, cuts, stops):
        """The text form: tokens of a group side by side, A before B, in one order over both sides."""
        size, size_b = len(self.a.bytes), len(self.b.bytes)
        code_a = ids_a + size * (ends_a == cuts[group_a]) if len(cuts) else ids_a
        code_b = 2 * size + ids_b + (size_b * (ends_b == cuts[group_b]) if len(cuts) else 0)
        # A token comes after all of B's in earlier groups, a token of B after all of A's up to its own.
        place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, side="left")
        place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[place_a], codes[place_b] = code_a, code_b
        written, get, out, before = codes.tolist(), self.written.__getitem__, [], 0
        for stop in stops.tolist():
            out.append("".join(map(get, written[before:stop]))[:-1])
            before = stop
        return out


@lru_cache(2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _chunks(texts: pa.Array, limit: int = BATCH_BYTES):
    """Ranges of rows whose texts hold about ``limit`` bytes together; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(sizes):
        yield start, len(sizes)


ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pairs binary, times binary")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Groups and links of every row: ``row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times``.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``.  ``pairs`` holds the distinct linked id pairs as ascending 64-bit
    numbers, A's id in the upper half; ``times`` how often each is linked, as 32-bit numbers.  ``row`` numbers the rows.
    """

    def run(batches):
        made = aligner(path_a or tokens.public_path(tokens.BYTE_RANKS), path_b or tokens.public_path(PIECES))
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            for start, stop in _chunks(batch.column(1)):
                part = batch.slice(start, stop - start)
                got = made.align(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + len(part))), part.column(0), pa.array(got.n_a),
                    pa.array(got.n_b), pa.array(got.n_groups), pa.array(got.n_links),
                    pa.array(got.groups, pa.string()),
                    pa.array([p.astype("<i8").tobytes() for p in got.pairs], pa.binary()),
                    pa.array([t.astype("<i4").tobytes() for t in got.times], pa.binary()),
                ], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
                row += len(part)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row holds."""
    raw = column.to_pylist()
    data = np.frombuffer(b"".join(raw), kind)
    return data, np.array([len(x) for x in raw], np.int64) // data.itemsize


def pair_documents(aligned: DataFrame) -> DataFrame:
    """``pair, a, n``: in how many rows each id pair is linked; added up in tasks, then by one shuffle."""

    def run(batches):
        held, size = [], 0

        def merged():
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([n for _, n in held])[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            return keys[first], np.add.reduceat(n, first)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], ["pair", "n"])

        for batch in batches:
            found, _ = _joined(batch.column(0), "<i8")
            if not len(found):
                continue
            held.append(np.unique(found, return_counts=True))
            size += len(held[-1][0])
            if size > HELD_PAIRS:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield out()
                    held, size = [], 0
        if held:
            held = [merged()]
            yield out()

    found = aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return found.select("pair", F.shiftright("pair", PAIR_BITS).alias("a"), "n")


def _least_heavy(counts: DataFrame, heavy: int) -> int:
    """The least count such that at most ``heavy`` pairs have it or more; from a histogram of fixed size."""
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(
        1024 + F.floor(F.log2(F.col("n") / 1024) * 16)).cast("long")
    bins = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least"))
                  .collect(), reverse=True)
    total, least = 0, 1 << 62
    for one in bins:
        total += one["pairs"]
        if total > heavy:
            break
        least = one["least"]
    return least


def count_links(aligned: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``aligned`` without its pairs, with ``n_best`` and ``count_sum``.

    The count of an id pair is the number of rows that hold it linked.  ``count_sum`` adds the counts of all
    links of a row; ``n_best`` is the number of its links whose count is the highest any pair of their A id has.
    ``aligned`` should be a written table: it is read up to three times.
    """
    spark = aligned.sparkSession
    scratch = Scratch(spark, "alignment")
    counts = scratch.keep(pair_documents(aligned), "pairs")
    least = _least_heavy(counts, heavy)
    rare = counts.where(F.col("n") < least)
    # At most one row for each id of A.
    best = counts.groupBy("a").agg(F.max("n").alias("best"))
    known = counts.where(F.col("n") >= least).join(F.broadcast(best), "a").select("pair", "n", "best").toArrow()
    keys = known.column("pair").to_numpy()
    order = np.argsort(keys)
    n = known.column("n").to_numpy()[order]
    sent = spark.sparkContext.broadcast((keys[order], n, n == known.column("best").to_numpy()[order]))
    others = [c for c in aligned.columns if c not in ("pairs", "times")]

    def look_up(batch):
        pair, sizes = _joined(batch.column("pairs"), "<i8")
        times, _ = _joined(batch.column("times"), "<i4")
        keys, n, is_best = sent.value
        at = np.searchsorted(keys, pair)
        at[at == len(keys)] = 0
        found = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
        return pair, times.astype(np.int64), sizes, at, found, n, is_best

    def run(batches):
        for batch in batches:
            _, times, sizes, at, found, n, is_best = look_up(batch)
            row = np.repeat(np.arange(len(sizes)), sizes)[found]
            at, times = at[found], times[found]
            total, bests = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(total, row, times * n[at])
            np.add.at(bests, row, times * is_best[at])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(bests), pa.array(total)],
                                             [*others, "n_best", "count_sum"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in aligned.select(*others).dtypes)
    summed = aligned.mapInArrow(run, f"{kinds}, n_best long, count_sum long")
    if rare.isEmpty():
        return summed

    def left(batches):
        for batch in batches:
            pair, times, sizes, _, found, _, _ = look_up(batch)
            row = np.repeat(batch.column("row").to_numpy(), sizes)[~found]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(pair[~found]), pa.array(times[~found])],
                                             ["row", "pair", "times"])

    weighed = rare.join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
    more = (aligned.select("row", "pairs", "times").mapInArrow(left, "row long, pair long, times long")
            .join(weighed, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return (summed.join(more, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
            .drop("more_best", "more_sum"))


def summarise(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """:func:`align` and :func:`count_links` through a written table, with the digest of the groups for their text."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = align(docs).withColumn("groups_sha256", digest).drop("groups")
    return count_links(Scratch(docs.sparkSession, "alignment").keep(aligned, "documents"), heavy)
