"""A task of the keyword scan looks up a bounded number of words at once."""

import random

import numpy as np
import pyarrow as pa

from findry.functions import kernels
from findry.operators import keyword


def test_documents_of_a_batch_are_offered_in_bounded_parts(monkeypatch):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    lists = [[rnd.choice(words) for _ in range(rnd.randint(0, 40))] for _ in range(60)] + [None, ["w1"] * 300]
    batch = pa.record_batch({"id": pa.array(range(len(lists))), "terms": pa.array(lists, pa.list_(pa.string()))})
    terms = keyword._query_terms(pa.table({
        "query_id": [0, 1], "terms": [["w1", "w2"], ["w3", "w4", "w5"]],
        "weights": [[0.5, 2.0], [1.0, 0.25, 3.0]]}))
    sizes = []
    add = kernels.BestMatches.add

    def watched(self, ids, row, term, count):
        sizes.append((len(ids), len(term)))
        add(self, ids, row, term, count)

    monkeypatch.setattr(kernels.BestMatches, "add", watched)
    found = []
    for most in (keyword.TERMS_AT_ONCE, 100, 1):
        monkeypatch.setattr(keyword, "TERMS_AT_ONCE", most)
        sizes.clear()
        best = kernels.BestMatches(terms, 5)
        keyword._add(best, batch)
        assert sum(n for _, n in sizes) == sum(len(x or []) for x in lists)
        assert all(n <= most or docs == 1 for docs, n in sizes)
        query, ids, distance = best.result()
        found.append((query.tolist(), ids.to_pylist(), distance.tolist()))
    assert found[0] == found[1] == found[2] and np.bincount(found[0][0]).tolist() == [5, 5]
