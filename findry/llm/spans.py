"""Substring dedup by sliding sentence spans.

A text is cut into sentences; from every sentence starts a run of ``RUN`` sentences, longer only
where these hold fewer than ``LEAST_WORDS`` words.  Every run is hashed to 128 bits (a rolling hash of its words)
and runs are joined over the whole table.  The first run of its kind, by doc_id and then by place, stays; sentences
covered by any other are removed, character for character, with the space that follows them.

Sentences above ``LONG`` words (lists, text without full stops) are cut further at words that the
text itself picks, so equal passages are cut alike whatever stands around them.

Passages that start and end inside sentences are met by shingles of ``SHINGLE`` words, wherever sentences
end.  Of every ``WINDOW`` that follow each other the one of least hash is joined like a run (winnowing), so
two texts that share SHINGLE + WINDOW - 1 = 51 words share one, and those of a longer passage join up.
Up to 25 words at either edge of a passage may stay.  Chinese and Japanese characters count as words there.

Rows of different text under one doc_id are told apart, as a run must be found again before it is
removed.  Rows that repeat both doc_id and text are alike: what one keeps, all keep.  A null text
stays null; a row without doc_id stays whole and counts as the first.  Texts of fewer than RUN sentences
are one run if they have LEAST_WORDS words.  Extra columns pass through ``clean``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.llm.scratch import Scratch

RUN = 3
LEAST_WORDS = 12
LONG = 24
PIECE = 8
SHINGLE = WINDOW = 26

# Chinese and Japanese characters, which no spaces divide: each is a unit of shingles, and two count as
# a word in runs.
_ALONE = "\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_CHARACTER = re.compile(f"[{_ALONE}]")
_UNIT = re.compile(f"[{_ALONE}]|[^\\s{_ALONE}]+")
_END = re.compile(r"(?:[.!?]+[\"')\]»”]*\s|[。！？]|\n)\s*")
_GAP = re.compile(r"\s+")


def _pieces(text: str) -> tuple[list[int], list[int]]:
    """Starts of the sentences (and the end of the text), and their words; together they tile the text."""
    starts, counts = [], []
    at = 0
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        n = len(text[at:end].split())
        if not n:  # blank lines belong to the sentence before
            if not starts:
                continue
        elif n <= LONG:
            starts.append(at)
            counts.append(n)
        else:
            words = text[at:end].lower().split()
            first = 0
            spots = [at, *(m.end() + at for m in _GAP.finditer(text[at:end].rstrip()))]
            if len(spots) != n:  # leading blanks make one spot more
                spots = [at, *spots[2:]]
            for i, word in enumerate(words):
                if i + 1 == n or i + 1 - first >= PIECE and (
                        word[-1] in ",;:" or crc32(word.encode("utf-8", "surrogatepass")) % 4 == 0):
                    starts.append(spots[first])
                    counts.append(i + 1 - first)
                    first = i + 1
        at = end
    starts.append(len(text))
    return starts, counts


def sentences(text: str) -> tuple[list[int], list[str], list[int]]:
    """Starts of the sentences (and the end of the text), their words joined in lower case, counts."""
    starts, counts = _pieces(text)
    return starts, [" ".join(text[a:b].lower().split()) for a, b in zip(starts, starts[1:])], counts


def _weight(piece: str, count: int) -> int:
    return count if piece.isascii() else max(count, len(_CHARACTER.findall(piece)) // 2)


def runs(norms: list[str], counts: list[int]) -> list[tuple[int, int]]:
    """(first, one past the last) sentence of every run."""
    first, end = _runs(np.array([_weight(t, c) for t, c in zip(norms, counts)], np.int64))
    return list(zip(first.tolist(), end.tolist()))


def _runs(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(weights)
    total = np.r_[0, np.cumsum(weights)]
    if 0 < n < RUN:
        some = np.arange(int(total[n] >= LEAST_WORDS))
        return some, some + n
    first = np.arange(max(0, n - RUN + 1))
    end = np.maximum(first + RUN, np.searchsorted(total, total[first] + LEAST_WORDS))
    return first[end <= n], end[end <= n]


# A stretch of units is hashed as a polynomial of the hashes of its units, modulo 2**64, for two bases.  Prefix
# sums give that of any stretch by one difference, which the inverse power of the base moves to the front.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_RUN_KIND, _SHINGLE_KIND = np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F85EBCA77)
_powers: list[np.ndarray] = []


class _Hashes(dict):
    """Hashes of lower-cased units, remembered."""

    def __missing__(self, unit: str) -> int:
        value = self[unit] = xxhash.xxh3_64_intdigest(unit.encode("utf-8", "surrogatepass"))
        return value


_hashed = _Hashes()


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of each base and of its inverse, n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(4096, 2 * n)
        made = []
        for base in _BASES:
            for factor in (base, pow(base, -1, 1 << 64)):
                row = np.full(size, factor, np.uint64)
                row[0] = 1
                made.append(np.multiply.accumulate(row))
        _powers[:] = made
    return _powers


class Text:
    """A text's sentences and units, with the hashes of stretches of units."""

    def __init__(self, text: str):
        self.text = text
        # Without characters that stand alone the units are the words.
        self.spaced = text.isascii() or _CHARACTER.search(text) is None
        units = text.lower().split() if self.spaced else [u.lower() for u in _UNIT.findall(text)]
        self.n = len(units)
        if len(_hashed) > 1 << 18:
            _hashed.clear()
        single = np.fromiter(map(_hashed.__getitem__, units), np.uint64, self.n)
        powers = _powers_to(self.n + 1)
        self.sums = [np.r_[np.uint64(0), np.cumsum(single * powers[j][:self.n])] for j in (0, 2)]
        self.inverse = [powers[1], powers[3]]

    def pieces(self) -> None:
        """Find the sentences: ``starts`` by character, ``edges`` by unit, ``weights`` in words."""
        self.starts, counts = _pieces(self.text)
        if self.spaced:
            sizes = weights = counts
        else:
            parts = [self.text[a:b] for a, b in zip(self.starts, self.starts[1:])]
            sizes = [len(_UNIT.findall(p)) for p in parts]
            weights = [_weight(p, c) for p, c in zip(parts, counts)]
        self.edges = np.r_[0, np.cumsum(np.array(sizes, np.int64))]
        self.weights = np.array(weights, np.int64)

    def digests(self, first: np.ndarray, end: np.ndarray, kind: np.uint64) -> np.ndarray:
        """Two 64-bit numbers for every stretch of units."""
        out = np.empty((len(first), 2), np.uint64)
        for j in (0, 1):
            out[:, j] = (self.sums[j][end] - self.sums[j][first]) * self.inverse[j][first]
        # The low bits of such sums depend on the low bits of the units only.
        out += (end - first).astype(np.uint64)[:, None] * kind
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
        return out

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First sentences, sentences past the last, and digests of the runs."""
        first, end = _runs(self.weights)
        return first, end, self.digests(self.edges[first], self.edges[end], _RUN_KIND).view(np.int64)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """First units of the chosen shingles, and their digests."""
        n = self.n - SHINGLE + 1
        if n < WINDOW:
            return np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
        at = np.arange(n)
        both = self.digests(at, at + SHINGLE, _SHINGLE_KIND)
        places = np.unique(_first_least(both[:, 0], WINDOW))
        own = both[places]
        # One that overlaps the first of its kind in the text would cut into it.
        _, first, kind = np.unique(own[:, 0], return_index=True, return_inverse=True)
        apart = places - places[first[kind]]
        keep = (apart == 0) | (apart >= SHINGLE)
        return places[keep], own[keep].view(np.int64)


def _first_least(values: np.ndarray, window: int) -> np.ndarray:
    """Place of the first least value of every window, from windows of doubled size."""
    least, place, size = values, np.arange(len(values)), 1
    while size < window:
        step = min(size, window - size)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        place = np.where(later, place[step:], place[:-step])
        size += step
    return place


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First units of the chosen shingles, and two 64-bit numbers for each."""
    return Text(text).shingles()


def _span_rows(batches):
    names = ["h1", "h2", "doc_id", "at", "again"]
    for batch in batches:
        hashes, ids, places, again = [], [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            parsed = Text(text)
            parsed.pieces()
            found, _, own = parsed.runs()
            chosen, more = parsed.shingles()
            if not len(found) and not len(chosen):
                continue
            own = np.concatenate([own, more])
            first = np.zeros(len(own), bool)
            first[np.unique(own[:, 0], return_index=True)[1]] = True
            hashes.append(own)
            ids += [doc_id] * len(own)
            # Shingles count down from -1.
            places.append(np.r_[found, -1 - chosen].astype(np.int32))
            again.append(~first)
        if not ids:
            continue
        both = np.concatenate(hashes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64()),
             pa.array(np.concatenate(places)), pa.array(np.concatenate(again))], names)


def repeated(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, __removals)``: place and hash of every run that isn't the first of its kind."""
    spans = scratch.keep(
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(_span_rows, "h1 long, h2 long, doc_id long, at int, again boolean"), "spans")
    # A document holds a kind once here, so a common kind is a partial count in every task.
    first = scratch.keep(
        spans.where("not again").groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"),
             F.count("doc_id").alias("named"))
        .where("n > 1")
        .select("h1", "h2", F.when(F.col("n") == F.col("named"), F.col("first")).alias("first")),
        "first")
    # A first occurrence without doc_id leaves `first` null: then every named one goes.
    later = (spans.where("not again").join(first, ["h1", "h2"])
             .where("doc_id > first or first is null").select("doc_id", "at", "h1"))
    within = spans.where("again").select("doc_id", "at", "h1")
    found = scratch.keep(
        later.unionByName(within).where("doc_id is not null").groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "h1")).alias("__removals")), "found")
    scratch.drop("spans", "first")
    return found


def cut(text: str, removals: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the runs at these places, what was cut as character ranges, sentences cut into."""
    parsed = Text(text)
    parsed.pieces()
    starts = parsed.starts
    wanted = np.array(sorted({(a, h) for a, h in removals if a >= 0}), np.int64).reshape(-1, 2)
    first, end = _runs(parsed.weights)
    ends = np.full(len(starts), -1)
    ends[first] = end
    wanted = wanted[wanted[:, 0] < len(starts)]
    wanted = wanted[ends[wanted[:, 0]] >= 0]
    first, end = wanted[:, 0], ends[wanted[:, 0]]
    own = parsed.digests(parsed.edges[first], parsed.edges[end], _RUN_KIND).view(np.int64)[:, 0]
    gone = np.zeros(len(starts) - 1, bool)
    for a, b in zip(first[own == wanted[:, 1]].tolist(), end[own == wanted[:, 1]].tolist()):
        gone[a:b] = True
    ranges = [(starts[i], starts[i + 1]) for i in np.flatnonzero(gone).tolist()]
    wanted = np.array(sorted({(-1 - a, h) for a, h in removals if a < 0}), np.int64).reshape(-1, 2)
    wanted = wanted[wanted[:, 0] <= parsed.n - SHINGLE]
    if len(wanted):
        first = wanted[:, 0]
        own = parsed.digests(first, first + SHINGLE, _SHINGLE_KIND).view(np.int64)[:, 0]
        places = [*(m.start() for m in _UNIT.finditer(text)), len(text)]
        ranges += [(places[a], places[a + SHINGLE]) for a in first[own == wanted[:, 1]].tolist()]
    if not ranges:
        return text, [], 0
    merged: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    ranges, firsts = merged, [a for a, _ in merged]
    touched = 0
    for a, b in zip(starts, starts[1:]):
        i = bisect_left(firsts, b) - 1
        touched += i >= 0 and ranges[i][1] > a
    kept, at = [], 0
    for a, b in ranges:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return "".join(kept), ranges, touched


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with shortened texts, plus ``n_removed`` and ``removed`` (character ranges).

    Columns of these names in the input are replaced.
    """
    scratch = Scratch(docs.sparkSession, "spans")
    found = repeated(docs, scratch)
    docs = docs.drop("n_removed", "removed")
    id_type = docs.schema["doc_id"].dataType
    joined = docs.join(found.withColumn("doc_id", F.col("doc_id").cast(id_type)), "doc_id", "left")
    joined = joined.select(*docs.columns, "__removals")
    ranges = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                       T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_removed", T.LongType()),
                           T.StructField("removed", ranges)])
    place = docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts, numbers, cuts = [], [], []
            for text, removals in zip(batch.column(place).to_pylist(),
                                      batch.column("__removals").to_pylist()):
                ranges, n = [], 0
                if text and removals:
                    text, ranges, n = cut(text, [(r["at"], r["h1"]) for r in removals])
                texts.append(text)
                numbers.append(n)
                cuts.append([{"start": a, "end": b} for a, b in ranges])
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(numbers, pa.int64()), pa.array(cuts, kind)],
                [*batch.schema.names[:-1], "n_removed", "removed"])

    return joined.mapInArrow(run, schema)
