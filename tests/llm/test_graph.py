"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest

from findry.llm import graphdedup


def vectors(seed=1, n=700, dim=24):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dim))
    ball = rnd.normal(size=dim) + 0.02 * rnd.normal(size=(150, dim))
    x = np.r_[x, x[:60] + 0.05 * rnd.normal(size=(60, dim)), ball, x[5:8], x[5:8] * 3]
    labels = rnd.integers(3, size=len(x))
    labels[:60], labels[n:n + 60], labels[n + 60:n + 210] = 0, 0, 2
    labels[5:8] = labels[-6:] = 1
    return x, labels


def plain(x, labels):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (u @ u.T >= graphdedup.COSINE) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(hit, False)
    least = np.arange(len(x))
    while True:
        low = np.minimum(least, np.where(hit, least[None, :], len(x)).min(axis=1))
        if (low == least).all():
            return hit.sum(axis=1), least
        least = low


@pytest.mark.parametrize("region,block", [(2_000, 20_000), (60, 100)])
def test_links_and_groups_are_those_of_all_pairs(spark, monkeypatch, region, block):
    monkeypatch.setattr(graphdedup, "REGION", region)
    monkeypatch.setattr(graphdedup, "BLOCK", block)
    x, labels = vectors()
    frame = spark.createDataFrame(
        [(i, v, int(g)) for i, (v, g) in enumerate(zip(x.tolist(), labels))],
        "vec_id long, embedding array<double>, label int")
    found, recall = graphdedup.near_duplicates(frame)
    rows = found.toPandas().sort_values("vec_id")
    links, least = plain(x, labels)
    assert recall >= 0.99
    assert (rows["n_links"].to_numpy() <= links).all()
    assert rows["n_links"].sum() >= 0.995 * links.sum()
    assert (rows["component_id"].to_numpy() == least).mean() >= 0.995
    assert (rows["kept"] == (rows["vec_id"] == rows["component_id"])).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None),
            (5, None, 0), (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0),
            (9, [None, 1.0], 0), (10, [2.0, 0.01], 0), (11, [1.0, 0.0, 0.0], 0), (12, [], 0),
            (None, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (13, [0.0, 1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found, _ = graphdedup.near_duplicates(frame)
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in found.collect())
    assert len(got) == len(rows)
    by = {g[0]: g[1:] for g in got}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[10] == (3, 1, False)
    for alone in (3, 4, 5, 6, 7, 8, 9, 11, 12, 13):
        assert by[alone] == (0, alone, True)
    empty, recall = graphdedup.near_duplicates(frame.where("false"))
    assert empty.count() == 0 and recall == 1.0


def test_pruned_graph_reaches_what_is_in_range():
    x, _ = vectors(3, 1200, 16)
    u = graphdedup.unit(x)
    graph = graphdedup.build(u, graphdedup.Effort())
    a, b = graphdedup.search(graph, u, 0.98, graphdedup.Effort())
    want = int((u @ u.T >= 0.98).sum())
    assert len(a) == len({*zip(a.tolist(), b.tolist())})
    assert len(a) >= 0.99 * want
    assert len(graph.targets) < 40 * len(u)
