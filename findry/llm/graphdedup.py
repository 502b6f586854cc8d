"""Embedding near-duplicates by range search over a robust-pruned flat graph.

Vectors compare only within a label.  Copies of one vector are a single point with a weight.  Points are
dealt to regions, one per label and centroid; a point also enters every region whose border it
is nearer to than ``MARGIN``, so that both ends of a close pair meet.  Inside a region:

1. overlapping cluster shards of some hundreds of points give every point its nearest neighbours,
   which robust pruning (Vamana, Subramanya and others 2019) thins out to edges of different directions;
2. the adjacency lists of the shards, and their reverses, are united to one flat graph;
3. every point that has its home in the region starts at the medoids of the shards closest to it, walks
   greedily with a beam, and then expands through all points within the range and a little beyond;
4. hits are verified by their cosine in double precision.

A region above ``BLOCK`` points is cut into blocks; each block of home points meets each block of
members in a group of its own, so no group outgrows its bound and nothing is left out.  A group
passes on one count per point and a spanning forest of its links, never pairs.

Recall is audited: a bounded sample of points is compared with all points of its label in blocks.  Below
``RECALL`` the search is run again with wider margins; below it even then, it raises.

Null labels and null, zero, or non-finite vectors (null elements included) link with nothing.
Vectors of unlike length never link.  vec_id is taken as unique: rows sharing one get the sum of their links.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm.components import components
from findry.llm.scratch import Scratch

COSINE = 0.98
REGION = 2_000
CENTROIDS = 16_384
PER_CENTROID = 64
BLOCK = 20_000
AUDIT = 512
RECALL = 0.9


@dataclass(frozen=True)
class Effort:
    """Width of the search.  MARGIN is the distance to a border, see above."""

    margin: float = 0.06
    shard: int = 400
    candidates: int = 24
    degree: int = 12
    alpha: float = 1.2
    beam: int = 12
    slack: float = 0.02

    def wider(self) -> Effort:
        return Effort(3 * self.margin, 2 * self.shard, 2 * self.candidates, 2 * self.degree,
                      self.alpha, 4 * self.beam, 3 * self.slack)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(x: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors, evenly picked at first; a few rounds of k-means."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[a:a + 4096] @ c.T).argmax(axis=1) for a in range(0, len(x), 4096)])
        order = np.argsort(near, kind="stable")
        starts = np.searchsorted(near[order], np.arange(k))
        sizes = np.diff(np.r_[starts, len(x)])
        sums = np.add.reduceat(x[order], np.minimum(starts, len(x) - 1), axis=0)
        norms = np.linalg.norm(sums, axis=1)
        moved = (sizes > 0) & (norms > 1e-9)
        c[moved] = sums[moved] / norms[moved, None]
    return c


def robust_prune(sims: np.ndarray, effort: Effort) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges (from, to) of a shard, given the cosines of all its pairs."""
    n = len(sims)
    width = min(effort.candidates, n - 1)
    if width < 1:
        return []
    sims = sims.copy()
    np.fill_diagonal(sims, -2)
    near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
    rows = np.arange(n)[:, None]
    order = np.argsort(-sims[rows, near], axis=1, kind="stable")
    near = near[rows, order]
    away = np.sqrt(np.maximum(2 - 2 * sims[rows, near], 0))
    kept = np.zeros((n, width), bool)
    kept[:, 0] = True
    for t in range(1, width):
        # A candidate goes if a kept neighbour is much closer to it than the point itself is.
        between = np.sqrt(np.maximum(2 - 2 * sims[near[:, :t], near[:, t:t + 1]], 0))
        hidden = (kept[:, :t] & (effort.alpha * between <= away[:, t:t + 1])).any(axis=1)
        kept[:, t] = ~hidden & (kept[:, :t].sum(axis=1) < effort.degree)
    at, place = np.nonzero(kept)
    return [(at, near[at, place])]


@dataclass
class Graph:
    points: np.ndarray
    starts: np.ndarray
    targets: np.ndarray
    medoids: np.ndarray

    def neighbours(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``nodes``, neighbour) of every edge that leaves them."""
        first, n = self.starts[nodes], self.starts[nodes + 1] - self.starts[nodes]
        place = np.repeat(np.arange(len(nodes)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return place, self.targets[np.repeat(first, n) + offset]


def build(points: np.ndarray, effort: Effort) -> Graph:
    """The united graph of overlapping shards over unit vectors."""
    n = len(points)
    k = max(1, math.ceil(n / effort.shard))
    c = centroids(points, k) if k > 1 else unit(points.mean(axis=0, keepdims=True) + 1e-12)
    sims = points @ c.T
    own = np.argpartition(-sims, min(1, k - 1), axis=1)[:, :2] if k > 1 else np.zeros((n, 1), int)
    edges, medoids = [], []
    for shard in range(k):
        members = np.flatnonzero((own == shard).any(axis=1))
        if not len(members):
            continue
        medoids.append(members[sims[members, shard].argmax()])
        # A shard of very many alike points is built in overlapping slices along its centroid.
        size = 4 * effort.shard
        members = members[np.argsort(sims[members, shard], kind="stable")]
        for a in range(0, max(1, len(members) - size // 4), size - size // 4):
            part = members[a:a + size]
            for i, j in robust_prune(points[part] @ points[part].T, effort):
                edges.append(np.stack([part[i], part[j]]))
    if edges:
        both = np.concatenate(edges, axis=1)
        codes = np.unique(np.r_[both[0] * n + both[1], both[1] * n + both[0]])
    else:
        codes = np.zeros(0, np.int64)
    starts = np.searchsorted(codes, np.arange(n + 1) * n)
    return Graph(points, starts, codes % n, np.array(medoids))


def search(graph: Graph, queries: np.ndarray, least: float, effort: Effort):
    """(query, point) of all pairs found with a cosine of about ``least`` or more."""
    points, n = graph.points, len(graph.points)
    step = max(16, min(1024, (64 << 20) // max(1, n)))
    found = []
    for at in range(0, len(queries), step):
        q = queries[at:at + step]
        rows = np.arange(len(q))
        seen = np.zeros(len(q) * n, bool)
        to_medoids = q @ points[graph.medoids].T
        first = np.argpartition(-to_medoids, min(1, to_medoids.shape[1] - 1), axis=1)[:, :2]
        pairs = np.unique((rows[:, None] * n + graph.medoids[first]).ravel())
        who, node = pairs // n, pairs % n
        cosine = np.einsum("ij,ij->i", q[who], points[node])
        seen[pairs] = True
        all_who, all_node, all_cos = [who], [node], [cosine]
        beam = np.full((len(q), effort.beam), -1)
        beam_cos = np.full((len(q), effort.beam), -2.0)
        done = np.zeros((len(q), effort.beam), bool)
        while True:
            # New points enter the beams of their queries.
            if len(who):
                order = np.lexsort((-cosine, who))
                w, v, s = who[order], node[order], cosine[order]
                rank = np.arange(len(w)) - np.searchsorted(w, w)
                top = rank < effort.beam
                fresh = np.full((len(q), effort.beam), -1)
                fresh_cos = np.full((len(q), effort.beam), -2.0)
                fresh[w[top], rank[top]], fresh_cos[w[top], rank[top]] = v[top], s[top]
                joint = np.concatenate([beam_cos, fresh_cos], axis=1)
                pick = np.argsort(-joint, axis=1, kind="stable")[:, :effort.beam]
                beam = np.take_along_axis(np.concatenate([beam, fresh], axis=1), pick, axis=1)
                beam_cos = np.take_along_axis(joint, pick, axis=1)
                done = np.take_along_axis(np.concatenate([done, np.zeros_like(done)], axis=1),
                                          pick, axis=1)
            open_ = ~done & (beam >= 0)
            active = np.flatnonzero(open_.any(axis=1))
            if not len(active):
                break
            best = open_[active].argmax(axis=1)
            done[active, best] = True
            place, node = graph.neighbours(beam[active, best])
            who = active[place]
            who, node, cosine = _visit(who, node, seen, n, q, points)
            all_who.append(who)
            all_node.append(node)
            all_cos.append(cosine)
        # From all within the range and a little more, on through their neighbours.
        who, node, cosine = map(np.concatenate, (all_who, all_node, all_cos))
        near = cosine >= least - effort.slack
        who, node, cosine = who[near], node[near], cosine[near]
        while len(who):
            hit = cosine >= least - 1e-5
            found.append(np.stack([who[hit] + at, node[hit]]))
            place, on = graph.neighbours(node)
            who, node, cosine = _visit(who[place], on, seen, n, q, points)
            near = cosine >= least - effort.slack
            who, node, cosine = who[near], node[near], cosine[near]
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)


def _visit(who, node, seen, n, q, points):
    """Pairs not seen before, now seen, with their cosine."""
    codes = who * n + node
    codes = np.unique(codes[~seen[codes]])
    seen[codes] = True
    who, node = codes // n, codes % n
    cosine = np.empty(len(codes))
    for a in range(0, len(codes), 1 << 16):
        cosine[a:a + (1 << 16)] = np.einsum("ij,ij->i", q[who[a:a + (1 << 16)]],
                                            points[node[a:a + (1 << 16)]])
    return who, node, cosine


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node it hangs together with by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if np.array_equal(low, label):
            return label
        label = low


def _match(group: pd.DataFrame, least: float, effort: Effort):
    """Weighted links of the home points of a group, and a spanning forest of all its links."""
    members, home = group[group["member"]], group[group["home"]]
    empty = pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
    if not len(members) or not len(home):
        return empty
    x = unit(np.stack(members["v"].to_list()).astype(float))
    q = unit(np.stack(home["v"].to_list()).astype(float))
    a, b = search(build(x.astype(np.float32), effort), q.astype(np.float32), least, effort)
    ids, own = members["rep"].to_numpy(), home["rep"].to_numpy()
    exact = np.empty(len(a))
    for i in range(0, len(a), 1 << 16):
        exact[i:i + (1 << 16)] = np.einsum("ij,ij->i", q[a[i:i + (1 << 16)]], x[b[i:i + (1 << 16)]])
    good = (exact >= least) & (own[a] != ids[b])
    a, b = a[good], b[good]
    if not len(a):
        return empty
    links = np.zeros(len(own), np.int64)
    np.add.at(links, a, members["weight"].to_numpy()[b])
    both, place = np.unique(np.r_[own, ids], return_inverse=True)
    root = forest(place[:len(own)][a], place[len(own):][b], len(both))
    tree = np.flatnonzero(root != np.arange(len(both)))
    linked = np.flatnonzero(links)
    return pd.DataFrame({
        "a": np.r_[own[linked], both[tree]],
        "b": np.r_[np.full(len(linked), -1), both[root[tree]]],
        "n": np.r_[links[linked], np.zeros(len(tree), np.int64)]})


def _matcher(least: float, effort: Effort):
    def match(group: pd.DataFrame) -> pd.DataFrame:
        return _match(group, least, effort)

    return match


def _regions(points: DataFrame, effort: Effort) -> DataFrame:
    """Every point in its home region and in those whose border is within the margin."""
    largest = points.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k = min(CENTROIDS, math.ceil(largest / REGION))
    c, dim = None, 0
    if k > 1:
        total = points.count()
        share = min(1.0, k * PER_CENTROID / total)
        sample = points.where(F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 30))
                              <= int(share * (1 << 30))).select("rep", "v").toPandas()
        dim = int(sample["v"].map(len).mode().max())
        sample = sample[sample["v"].map(len) == dim].sort_values("rep")
        c = centroids(unit(np.stack(sample["v"].to_list()).astype(float)), min(k, len(sample)))
        gaps = np.sqrt(np.maximum(2 - 2 * c @ c.T, 1e-12))
    spark = points.sparkSession
    held = spark.sparkContext.broadcast(None if c is None else (c, gaps))

    def run(batches):
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            dims = np.array([len(v) for v in vectors])
            row, cell, home = [np.arange(len(vectors))], [np.full(len(vectors), -1)], [
                np.ones(len(vectors), bool)]
            if held.value is not None:
                c, gaps = held.value
                fit = np.flatnonzero(dims == dim)
                rest = np.flatnonzero(dims != dim)
                row, cell, home = [rest], [np.full(len(rest), -1)], [np.ones(len(rest), bool)]
                for a in range(0, len(fit), 512):
                    part = fit[a:a + 512]
                    sims = unit(np.array([vectors[i] for i in part], float)) @ c.T
                    best = sims.argmax(axis=1)
                    away = (sims[np.arange(len(part)), best][:, None] - sims) / gaps[best]
                    away[np.arange(len(part)), best] = 0
                    i, j = np.nonzero(away <= effort.margin)
                    row.append(part[i])
                    cell.append(j)
                    home.append(best[i] == j)
            row = np.concatenate(row)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(dims[row].astype(np.int32)),
                 pa.array(np.concatenate(cell).astype(np.int32)), pa.array(np.concatenate(home))],
                [*taken.schema.names, "dim", "cell", "home"])

    return points.select("rep", "label", "v", "weight").mapInArrow(
        run, "rep long, label string, v array<double>, weight long, dim int, cell int, home boolean")


def _groups(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """Regions as groups of bounded size: block of home points, block of members."""
    sizes = scratch.keep(
        placed.groupBy("label", "dim", "cell").count()
        .select("label", "dim", "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
        .where("blocks > 1"), "sizes")
    parts = F.coalesce("blocks", F.lit(1))
    known = placed.join(sizes, ["label", "dim", "cell"], "left").withColumn("blocks", parts)
    known = known.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    one = known.where("blocks = 1").select(
        *placed.columns, F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("member"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    big = known.where("blocks > 1")
    member = big.select(*[c for c in placed.columns if c != "home"], F.lit(False).alias("home"),
                        every.alias("i"), F.col("own").alias("j"), F.lit(True).alias("member"))
    home = big.where("home").select(*placed.columns, F.col("own").alias("i"), every.alias("j"),
                                    F.lit(False).alias("member"))
    return one.unionByName(member).unionByName(home)


def _audit(points: DataFrame, counts: DataFrame, least: float) -> float:
    """Share of the links of a sample of points, found by comparison with all points, that were found."""
    total = points.count()
    share = min(1.0, AUDIT / max(1, total))
    near = F.pmod(F.xxhash64("rep", F.lit(17)), F.lit(1 << 30)) <= int(share * (1 << 30))
    sample = points.where(near).select("rep", "label", "v").toPandas()
    spark = points.sparkSession
    held = spark.sparkContext.broadcast(
        {key: (g["rep"].to_numpy(), unit(np.stack(g["v"].to_list()).astype(float)))
         for key, g in sample.groupby([sample["label"], sample["v"].map(len)])})

    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            out = []
            for key, g in frame.groupby([frame["label"], frame["v"].map(len)]):
                if key not in held.value:
                    continue
                reps, q = held.value[key]
                for a in range(0, len(g), 1024):
                    part = g.iloc[a:a + 1024]
                    hit = q @ unit(np.stack(part["v"].to_list()).astype(float)).T >= least
                    hit &= reps[:, None] != part["rep"].to_numpy()[None, :]
                    n = hit @ part["weight"].to_numpy()
                    out.append(pd.DataFrame({"rep": reps, "n": n})[n > 0])
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out).astype("int64"), preserve_index=False)

    true = (points.select("rep", "label", "v", "weight").mapInArrow(run, "rep long, n long")
            .groupBy("rep").agg(F.sum("n").alias("n")))
    found = true.join(counts.withColumnRenamed("n", "found"), "rep", "left").agg(
        F.sum("n"), F.sum(F.least("n", F.coalesce("found", F.lit(0))))).first()
    held.destroy()
    return float(found[1] / found[0]) if found[0] else 1.0


def near_duplicates(vectors: DataFrame, least: float = COSINE, effort: Effort | None = None):
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors(vec_id, embedding, label)``,
    and the audited recall."""
    scratch = Scratch(vectors.sparkSession, "graph")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"),
                          F.col("embedding").cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < np.inf))
                       & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & sound)
    rows = rows.withColumns({"h1": F.xxhash64("label", "v"), "h2": F.xxhash64("v", "label")})
    copies = scratch.keep(rows.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "copies")
    named = scratch.keep(rows.join(copies, ["h1", "h2"]).select(
        "vec_id", "label", "rep", "weight", F.when(F.col("vec_id") == F.col("rep"), F.col("v"))
        .alias("v")), "named")
    points = scratch.keep(named.where("v is not null").dropDuplicates(["rep", "label", "v"])
                          .select("rep", "label", "v", "weight"), "points")
    effort = effort or Effort()
    for width in (effort, effort.wider()):
        placed = scratch.keep(_regions(points, width), "placed")
        found = scratch.keep(
            _groups(placed, scratch).groupBy("label", "dim", "cell", "i", "j").applyInPandas(
                _matcher(least, width), "a long, b long, n long"), "found")
        counts = scratch.keep(found.where("n > 0").groupBy(F.col("a").alias("rep"))
                              .agg(F.sum("n").alias("n")), "counts")
        recall = _audit(points, counts, least)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall of {recall:.3f} is below {RECALL}")
    scratch.drop("placed", "sizes")
    joined = components(found.where("n = 0").select("a", "b"), scratch)
    groups = scratch.keep(
        copies.select("rep", "weight").dropDuplicates(["rep"]).join(counts, "rep", "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select("rep", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "groups")
    # Rows that link with nothing are no part of `named`; all rows come back through their vec_id.
    results = named.join(groups, "rep").groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = vectors.select(F.col("vec_id").cast("long")).join(results, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), \
        recall
