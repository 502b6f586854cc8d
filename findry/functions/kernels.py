"""Numpy and Arrow helpers that run inside Spark tasks.

Each helper keeps, for a set of queries, the best ``k`` rows it has been shown so
far.  Spark decides which rows a task sees; a task's memory holds one Arrow batch,
the queries and at most ``k`` rows per query, however many rows pass through.

Distances that leave a task are always summed left to right in double precision,
the order ``aggregate(zip_with(...))`` uses in SQL.  Matrix products only choose
which pairs are worth that sum, with a slack above their rounding error, so the
outcome does not depend on how rows were split into tasks and batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pairs scored at once; bounds the scratch memory of a task.
PAIRS_AT_ONCE = 500_000
ULP = float(np.finfo(np.float64).eps)


def one_array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def to_matrix(column, dim: int | None = None) -> np.ndarray:
    """List column -> (rows, dim) float64 matrix; refuses ragged or null vectors."""
    column = one_array(column)
    if len(column) == 0:
        return np.empty((0, dim or 0))
    lengths = pc.list_value_length(column)
    low, high = pc.min_max(lengths).values()
    low, high = low.as_py(), high.as_py()
    if column.null_count or low != high or (dim is not None and high != dim):
        raise ValueError(
            f"embeddings must be non-null and all of one length (wanted {dim}, "
            f"got {low}..{high}, {column.null_count} null)"
        )
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("embedding holds a null element")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, high)


def sound(column) -> np.ndarray:
    """Which rows of a column can be searched: not null and, for vectors, all elements finite."""
    column = one_array(column)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    if not (pa.types.is_list(column.type) or pa.types.is_large_list(column.type)) or not (
            pa.types.is_floating(column.type.value_type)):
        return valid
    flat = column.flatten()
    good = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
    if good.all():
        return valid
    # Null lists are no part of the flat elements.
    row = np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy())
    out = valid.copy()
    out[row[~good]] = False
    return out


def running_sum(products: np.ndarray) -> np.ndarray:
    """Row sums added strictly left to right."""
    if products.shape[1] == 0:
        return np.zeros(products.shape[0])
    return np.add.accumulate(products, axis=1)[:, -1]


def pair_distance(metric: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distance of aligned rows of two matrices."""
    out = np.empty(left.shape[0])
    step = max(1, 1_000_000 // max(1, left.shape[1]))
    for at in range(0, left.shape[0], step):
        a, b = left[at:at + step], right[at:at + step]
        if metric == "euclidean":
            out[at:at + step] = np.sqrt(running_sum((a - b) * (a - b)))
        elif metric == "sqeuclidean":
            out[at:at + step] = running_sum((a - b) * (a - b))
        elif metric == "dot":
            out[at:at + step] = -running_sum(a * b)
        else:
            out[at:at + step] = 1.0 - similarity(a, b)
    return out


def similarity(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of aligned rows; zero when either is all zeros."""
    norms = np.sqrt(running_sum(left * left)) * np.sqrt(running_sum(right * right))
    zero = norms == 0
    return np.where(zero, 0.0, running_sum(left * right) / np.where(zero, 1.0, norms))


def diverse(queries: np.ndarray, candidates: np.ndarray, sizes: np.ndarray, k: int,
            balance: float) -> list[list[int]]:
    """For every query, places of up to ``k`` of its candidates, each close to it and unlike those before.

    ``candidates`` is (queries, places, dimension), of which the first ``sizes`` places count.  Greedy for all queries
    at once: every step takes the best of ``balance * similarity to the query - (1 - balance) * largest
    similarity to one already taken``, the earlier on a tie.
    """
    n, places, dim = candidates.shape
    flat = candidates.reshape(n * places, dim)

    def alike(vectors):
        return similarity(flat, np.repeat(vectors, places, axis=0)).reshape(n, places)

    near, worst = alike(queries), None
    open_ = np.arange(places)[None, :] < sizes[:, None]
    taken = np.full((n, min(k, places)), -1)
    for step in range(taken.shape[1]):
        gain = balance * near - (1.0 - balance) * (0.0 if worst is None else worst)
        pick = np.where(open_, gain, -np.inf).argmax(axis=1)
        left = open_[np.arange(n), pick]
        taken[left, step] = pick[left]
        open_[np.arange(n), pick] = False
        likeness = alike(candidates[np.arange(n), pick])
        worst = likeness if worst is None else np.maximum(worst, likeness)
    return [row[row >= 0].tolist() for row in taken]


class BestRows:
    """The best ``k`` (distance, id) rows of every query seen so far."""

    def __init__(self, n_queries: int, k: int):
        self.n_queries, self.k = n_queries, k
        self.kept = None
        self.bound = np.full(n_queries, np.inf)
        self.last_id = None

    def offer(self, query: np.ndarray, distance: np.ndarray, ids: pa.Array) -> None:
        wins = distance < self.bound[query]
        ties = np.flatnonzero(distance == self.bound[query])
        if len(ties):
            lower = pc.less(ids.take(pa.array(ties)), self.last_id.take(pa.array(query[ties])))
            wins[ties] = lower.to_numpy(zero_copy_only=False)
        if not wins.all():
            query, distance, ids = query[wins], distance[wins], ids.filter(pa.array(wins))
        if not len(query):
            return
        new = pa.table({"q": query.astype(np.int32), "d": distance, "id": ids})
        both = new if self.kept is None else pa.concat_tables([self.kept, new])
        both = both.take(pc.sort_indices(
            both, sort_keys=[("q", "ascending"), ("d", "ascending"), ("id", "ascending")]))
        q = both.column("q").to_numpy()
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        self.kept = both.filter(pa.array(place < self.k)).combine_chunks()
        full = np.flatnonzero(place == self.k - 1)
        self.bound[q[full]] = both.column("d").to_numpy()[full]
        at = np.full(self.n_queries, -1)
        at[q[full]] = full
        self.last_id = both.column("id").combine_chunks().take(pa.array(at, mask=at < 0))

    def result(self):
        """(query index, id, distance), grouped by query and best first."""
        if self.kept is None:
            return np.empty(0, np.int32), None, np.empty(0)
        return (self.kept.column("q").to_numpy(),
                self.kept.column("id").combine_chunks(),
                self.kept.column("d").to_numpy())


class NearestVectors(BestRows):
    """Nearest rows of each query vector.

    ``members`` limits which queries look at a row: it maps a row's group (its IVF
    list) to the indexes of the queries that probe it.
    """

    def __init__(self, queries: np.ndarray, k: int, metric: str, members=None):
        super().__init__(queries.shape[0], k)
        self.queries, self.metric, self.members = queries, metric, members

    def add(self, rows: np.ndarray, ids: pa.Array, groups: np.ndarray | None = None) -> None:
        if self.members is None:
            self._add_for(np.arange(self.n_queries), rows, ids)
            return
        for group in np.unique(groups):
            who = self.members.get(int(group))
            if who is not None:
                here = np.flatnonzero(groups == group)
                self._add_for(who, rows[here], ids.take(pa.array(here)))

    def _add_for(self, who, rows, ids) -> None:
        step = max(self.k, min(len(rows), PAIRS_AT_ONCE // max(1, min(len(who), 4096))), 1)
        for row_at in range(0, len(rows), step):
            block, block_ids = rows[row_at:row_at + step], ids.slice(row_at, step)
            for q_at in range(0, len(who), 4096):
                part = who[q_at:q_at + 4096]
                q, r = self._worth_scoring(part, block, block_ids)
                exact = pair_distance(self.metric, self.queries[part[q]], block[r])
                self.offer(part[q], exact, block_ids.take(pa.array(r)))

    def _worth_scoring(self, part, block, block_ids):
        """Pairs whose matrix-product distance is within slack of the k-th best."""
        queries, dim = self.queries[part], block.shape[1]
        q_norm = np.linalg.norm(queries, axis=1)
        b_norm = np.linalg.norm(block, axis=1)
        coarse = queries @ block.T
        bound = self.bound[part]
        longest = b_norm.max(initial=0.0)
        if self.metric in ("euclidean", "sqeuclidean"):
            coarse = (q_norm ** 2)[:, None] + (b_norm ** 2)[None, :] - 2.0 * coarse
            slack = 16 * dim * ULP * (q_norm + longest) ** 2
            bound = bound ** 2 if self.metric == "euclidean" else bound
        elif self.metric == "dot":
            coarse = -coarse
            slack = 16 * dim * ULP * q_norm * longest
        else:
            norms = q_norm[:, None] * b_norm[None, :]
            zero = norms == 0
            coarse = np.where(zero, 1.0, 1.0 - coarse / np.where(zero, 1.0, norms))
            slack = np.full(len(part), 16 * dim * ULP)
        if block.shape[0] > self.k:
            bound = np.minimum(bound, np.partition(coarse, self.k - 1, axis=1)[:, self.k - 1])
        bound = bound + slack + 16 * ULP * np.abs(np.where(np.isfinite(bound), bound, 0.0))
        # An overflow makes a distance or bound undefined; such pairs are scored exactly too.
        q, r = np.nonzero(~(coarse > bound[:, None]))
        if len(q) > 4 * self.k * len(part):
            keep = self._thin_copies(block, block_ids, np.unique(r))
            ok = keep[r]
            q, r = q[ok], r[ok]
        return q, r

    def _thin_copies(self, block, block_ids, rows):
        """Of rows with one and the same vector only the ``k`` lowest ids can win."""
        _, copy_of = np.unique(block[rows], axis=0, return_inverse=True)
        rank = np.empty(len(rows), np.int64)
        rank[pc.sort_indices(block_ids.take(pa.array(rows))).to_numpy()] = np.arange(len(rows))
        order = np.lexsort((rank, copy_of))
        copies = copy_of[order]
        place = np.arange(len(rows)) - np.searchsorted(copies, copies, side="left")
        keep = np.zeros(block.shape[0], bool)
        keep[rows[order[place < self.k]]] = True
        return keep


class BestMatches(BestRows):
    """Rows whose terms weigh most for each query.

    Query terms come as one list per vocabulary term: ``starts[t]:starts[t + 1]``
    spans the (query, weight) entries of term ``t``.  A row's score is
    ``sum(count * weight)`` over the terms it shares with the query, added in
    vocabulary order; rows sharing no term with a query have no cell, and ``cells`` counts those there are.
    """

    def __init__(self, terms: dict, k: int):
        super().__init__(terms["n_queries"], k)
        self.vocab = pa.array(terms["vocab"], pa.string())
        self.starts, self.who, self.weight = terms["starts"], terms["who"], terms["weight"]
        self.fan = np.diff(self.starts)
        self.cells = 0

    def add(self, ids: pa.Array, row: np.ndarray, term: pa.Array, count: np.ndarray | None) -> None:
        """``row[i]`` holds ``term[i]`` (``count[i]`` times, else once per entry)."""
        found = pc.index_in(term, value_set=self.vocab)
        hit = found.is_valid().to_numpy(zero_copy_only=False)
        if not hit.any():
            return
        key = row[hit].astype(np.int64) * len(self.vocab) + found.drop_null().to_numpy()
        key, back = np.unique(key, return_inverse=True)
        tf = np.bincount(back, weights=None if count is None else count[hit]).astype(np.float64)
        row, term = key // len(self.vocab), key % len(self.vocab)
        # A slice of rows ends where its query entries get too many.
        weighed = np.cumsum(self.fan[term])
        at = 0
        while at < len(row):
            done = weighed[at - 1] if at else 0
            end = int(np.searchsorted(weighed, done + PAIRS_AT_ONCE, side="right"))
            if end < len(row):
                whole = np.searchsorted(row, row[end], side="left")
                end = whole if whole > at else np.searchsorted(row, row[at], side="right")
            self._add_rows(ids, row[at:end], term[at:end], tf[at:end])
            at = end

    def _add_rows(self, ids, row, term, tf) -> None:
        fan = self.fan[term]
        total = int(fan.sum())
        entry = np.repeat(self.starts[term] - np.cumsum(fan) + fan, fan) + np.arange(total)
        # One cell for each row and query that share a word; its sum is added in the order of the words.
        cell, place = np.unique(np.repeat(row, fan) * self.n_queries + self.who[entry], return_inverse=True)
        self.cells += len(cell)
        distance = -np.bincount(place, weights=np.repeat(tf, fan) * self.weight[entry])
        r, q = cell // self.n_queries, cell % self.n_queries
        near = distance <= self.bound[q]
        r, q, distance = r[near], q[near], distance[near]
        # Of a query's cells those that are no further than its k-th; rows ascend, but ids need not.
        order = np.lexsort((distance, q))
        first = np.searchsorted(q[order], q[order], side="left")
        last = np.minimum(first + self.k - 1, np.searchsorted(q[order], q[order], side="right") - 1)
        kept = order[distance[order] <= distance[order][last]]
        self.offer(q[kept], distance[kept], ids.take(pa.array(r[kept])))
