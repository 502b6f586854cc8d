"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins.  Boosting goes round the features in turn; at each visit a shallow
tree over the bins of that one feature takes a small Newton step, and its leaves are added to the
feature's look-up table (Lou, Caruana and others 2012, 2013).  Afterwards the pairs whose quadrants explain
most of what is left get look-up tables of two dimensions, boosted the same way.  A score is a sum
of table entries, so a batch is scored by a few vectorised additions and each entry can be read.

Fitted on a bounded sample of labelled rows (``SAMPLE``).  Without labels of both kinds the score
is the share of label 1, or one half if there are none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm.scratch import Scratch
from findry.llm.textstats import RATIOS, labelled_sample, statistics

# Labelled rows the model is fitted on, at most (expected number of a hash sample).
SAMPLE = 40_000
BINS = 48
PAIR_BINS = 12
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.15
LEAST_LEAF = 5.0


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right")
                  for j in {j for pair in self.pairs for j in pair}}
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, splits: int = 3) -> np.ndarray:
    """Leaf values over ordered bins of a tree with at most ``splits`` splits."""
    cg, ch = np.r_[0, g.cumsum()], np.r_[0, h.cumsum()]
    leaves = [(0, len(g))]
    for _ in range(splits):
        best = None
        for at, (a, b) in enumerate(leaves):
            if b - a < 2:
                continue
            left_g, left_h = cg[a + 1:b] - cg[a], ch[a + 1:b] - ch[a]
            all_g, all_h = cg[b] - cg[a], ch[b] - ch[a]
            gains = (_gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h)
                     - _gain(all_g, all_h))
            gains[(left_h < LEAST_LEAF / 4) | (all_h - left_h < LEAST_LEAF / 4)] = -1
            i = int(gains.argmax())
            if gains[i] > 0 and (best is None or gains[i] > best[0]):
                best = (gains[i], at, a + 1 + i)
        if best is None:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a two-dimensional table into four, its gain and leaf values."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def parts(c):
        low, right, bottom, all_ = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return low, right - low, bottom - low, all_ - right - bottom + low

    pg, ph = parts(cg), parts(ch)
    gains = sum(_gain(a, b) for a, b in zip(pg, ph)) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.zeros_like(g)
    v = [a[i, j] / (b[i, j] + 1.0) for a, b in zip(pg, ph)]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(gains[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    model = Model()
    if not len(y):
        return model
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.intercept = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    n = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(n)]
    places = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(n):
            g, h = slopes()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(places[j], g, size), np.bincount(places[j], h, size))
            model.tables[j] += step
            total += step[places[j]]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(n)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(i, j, values):
        return np.bincount(coarse[i] * sizes[j] + coarse[j], values,
                           sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    ranked = sorted(((_quadrants(grid(i, j, g), grid(i, j, h))[0], i, j)
                     for i in range(n) for j in range(i + 1, n) if min(sizes[i], sizes[j]) > 1),
                    reverse=True)
    model.pairs = [(i, j) for _, i, j in ranked[:PAIRS]]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, h))[1]
            model.pair_tables[k] += step
            total += step[coarse[i], coarse[j]]
    return model


def held_out_remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; held-out labels are never learned from.

    Null and empty texts have all statistics zero and are scored like any other. A null doc_id
    counts as not held out; it has no label to learn from.
    """
    stats = Scratch(docs.sparkSession, "additive").keep(statistics(docs), "stats")
    learnable = labels.where(held_out_remainder() != 1)
    known = labelled_sample(stats, learnable, "quality", sample, RATIOS)
    model = fit(known[list(RATIOS)].to_numpy(float), known["y"].to_numpy(float))

    def run(batches):
        for batch in batches:
            x = np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in RATIOS], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    scored = stats.select("doc_id", *RATIOS).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out_remainder() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
