"""Near-duplicate documents by SimHash and covering locality-sensitive hashing.

A fingerprint has 64 bits, each the majority over the hashes of all 4-word shingles.  Two
fingerprints are linked if at most ``RADIUS`` bits differ.  Candidates come from the covering
family of Pagh ("CoveringLSH", 2018): every bit position gets a random non-zero vector of
RADIUS + 1 bits; table ``v`` (a non-zero vector too) keeps the positions whose vector has an odd
product with ``v``.  RADIUS differing positions span at most RADIUS dimensions, so some ``v`` is
orthogonal to all of them: that table masks every difference away and both fingerprints fall into
one bucket.  No pair within the radius is ever missed, whatever the random choice.

Copies of one fingerprint are grouped first, so buckets hold different fingerprints only.  A bucket
is streamed through one task; it passes on a spanning forest of its verified links, not its pairs.
A bucket above ``SPLIT`` members is divided by a second covering family, which again
loses nothing.

Null and empty texts have fingerprint zero and so form one group like any other copies.  Extra
columns are ignored.  Every row gets a result; rows that share a doc_id are judged each by its own
text, rows whose doc_id is null join the group of their text.  An empty table gives an empty one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm.components import components
from findry.llm.scratch import Scratch

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
SPLIT = 20_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text as a signed 64-bit number."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - [len(w) + 1 for w in words]
    ends = (ends - 1).tolist()[min(SHINGLE, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` for every row; one pass, no shuffle."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())],
                                             ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


@lru_cache(8)
def masks(radius: int = RADIUS, seed: int = 7) -> tuple[int, ...]:
    """Masks of the covering family: 2 ** (radius + 1) - 1 numbers of 64 bits."""
    of_bit = np.random.default_rng(seed).permutation(
        np.resize(np.arange(1, 1 << (radius + 1)), BITS))
    return tuple(sum(1 << i for i in range(BITS) if int(v & of_bit[i]).bit_count() % 2)
                 for v in range(1, 1 << (radius + 1)))


class Forest:
    """Union-find over the members of one bucket."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def roots(self) -> np.ndarray:
        while True:
            above = self.root[self.root]
            if np.array_equal(above, self.root):
                return above
            self.root = above


def spanning_links(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Places (i, j) whose links connect exactly what the links of all pairs connect."""
    forest, links = Forest(len(fps)), []
    blocks = [np.arange(len(fps))]
    if len(fps) > SPLIT:
        blocks = []
        for mask in masks(radius, 11):
            key = fps & np.uint64(mask)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            blocks += [b for b in np.split(order, cuts) if len(b) > 1]
    for block in blocks:
        own = fps[block]
        for lag in range(1, len(block)):
            near = np.flatnonzero(np.bitwise_count(own[lag:] ^ own[:-lag]) <= radius)
            if not len(near):
                continue
            roots = forest.roots()
            i, j = block[near], block[near + lag]
            open_ = roots[i] != roots[j]
            for a, b in zip(i[open_].tolist(), j[open_].tolist()):
                x, y = forest.find(a), forest.find(b)
                if x != y:
                    forest.root[max(x, y)] = min(x, y)
                    links.append((a, b))
    return links


def _bucket_links(batches):
    """Rows sorted by (table, bucket) -> links; a bucket may run over several batches."""

    def close(places, fps, reps):
        out = []
        pairs = []
        starts = np.flatnonzero(np.r_[True, np.any(places[1:] != places[:-1], axis=1)])
        sizes = np.diff(np.r_[starts, len(fps)])
        small = starts[sizes == 2]
        pairs.append(small[np.bitwise_count(fps[small] ^ fps[small + 1]) <= RADIUS])
        out.append(np.stack([reps[pairs[0]], reps[pairs[0] + 1]], 1))
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            found = spanning_links(fps[at:at + n])
            if found:
                out.append(reps[at:at + n][np.array(found)])
        both = np.concatenate(out)
        return pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], ["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        places = np.stack(cols[:2], 1)
        last = places[-1]
        same = np.all(places == last, axis=1)
        cut = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        held = [c[cut:] for c in cols]
        if cut:
            yield close(places[:cut], cols[2][:cut].view(np.uint64), cols[3][:cut])
    if held is not None and len(held[0]) > 1:
        yield close(np.stack(held[:2], 1), held[2].view(np.uint64), held[3])


def bucket_links(groups: DataFrame) -> DataFrame:
    """Verified links ``(a, b)`` between the rows of ``groups(fp, rep)``, distinct fingerprints."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks()]
    tables = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
    placed = groups.select("fp", "rep", tables.alias("table", "bucket"))
    n = groups.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return (placed.select("table", "bucket", "fp", "rep")
            .repartition(int(n), "table", "bucket").sortWithinPartitions("table", "bucket", "fp")
            .mapInArrow(_bucket_links, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep(fingerprints(docs), "prints")
    groups = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "groups")
    links = bucket_links(groups)
    found = components(links, scratch)
    named = scratch.keep(
        groups.join(found, groups.rep == found.node, "left")
        .select("fp", F.coalesce("component", "rep").alias("component_id")), "named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but the least doc_id of each group; columns unchanged.

    A document goes only if no row of its doc_id is the least of its group.  Rows that repeat a
    doc_id stay or go together; rows without doc_id stay.
    """
    gone = (near_duplicates(docs).groupBy("doc_id")
            .agg(F.max(F.col("doc_id") == F.col("component_id")).alias("least"))
            .where("not least").select("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
