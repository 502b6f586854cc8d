"""Hard negatives against brute force over exact integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from findry.llm import negatives, queries
from findry.sources import chunks

SCHEMA = "vec_id long, label int, embedding array<double>, n int"


def brute_force(rows, n_pos=5, n_neg=10):
    usable = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    asked = {}
    for row in sorted(usable):
        if row[0] % 100 == 0:
            asked.setdefault(row[0], row)
    out = []
    for anchor, label, v in asked.values():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, other) for i, other, w in usable
                        if i != anchor and len(w) == len(v))
        for s, positive, _ in [x for x in scored if x[2] == label][:n_pos]:
            window = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:n_neg]
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i, _) in enumerate(window, 1)]
    return sorted(out)


def vectors(seed, n=900, dim=9, scale=1.0):
    rnd = random.Random(seed)
    hot = [rnd.gauss(0.3, 1) * scale for _ in range(dim)]
    rows = []
    for i in range(n):
        v = list(hot) if rnd.random() < 0.3 else [rnd.gauss(0.3, 1) * scale for _ in range(dim)]
        rows.append((i * 5 - 500, 3 if rnd.random() < 0.4 else rnd.randint(0, 4), v))
    return rows


def odd(rows):
    v = rows[0][2]
    return rows + [(None, 1, v), (1, None, v), (2, 1, None), (3, 1, [None] + v[1:]), (4, 1, [math.nan] + v[1:]),
                   (6, 1, [-math.inf] + v[1:]), (100, 2, v[:4]), (200, 2, v[:4]), (300, 1, []), (101, 2, v[:4]),
                   (102, 3, v[:4]), (400, 2, v), (400, 1, v), (7, 0, [0.0] * len(v))]


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(parts)


def mined(found):
    return sorted(tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("size", [1.0, 100.0, 1 / 512, 1e-4, 7e5, 7e8])
@pytest.mark.parametrize("dim", [1, 64, 130])
def test_products_are_exact(size, dim):
    rng = np.random.default_rng(dim)
    most = np.sqrt(negatives.LARGEST / dim) / 256
    a, b = (np.floor(np.clip(rng.normal(0, min(size, most / 3), (20, dim)), -most, most) * 256 * .99)
            for _ in range(2))
    b[:5] = -a[:5]
    b[5:8] = a[5:8]
    got = negatives.products(negatives.Rows(a), negatives.Rows(b))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert got.tolist() == want


@pytest.mark.parametrize("held, files", [(chunks.HELD_BYTES, negatives.ANCHOR_BYTES), (3000, 700)])
def test_mining_equals_brute_force(spark, held, files, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_BLOCK", 50)
    rows = odd(vectors(1))
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, held_bytes=held, anchor_bytes=files)
    want = brute_force(rows)
    assert mined(got) == want and len(want) > 1000


def test_rows_do_not_depend_on_the_layout(spark):
    rows = vectors(2, 400, 70, 40.0)
    asked = F.col("vec_id") % 100 == 0
    assert mined(negatives.mine(frame(spark, rows, 1), asked)) == mined(
        negatives.mine(frame(spark, rows[::-1], 7), asked)) == brute_force(rows)


def test_large_rows_take_no_part(spark):
    rows = vectors(3, 100, 4)
    extra = [(100, 1, [1e30, 0.0, 0.0, 0.0]), (8, 1, [3e305, 0.0, 0.0, 0.0]), (9, 2, [1e18, 1e18, 0.0, 0.0])]
    asked = F.col("vec_id") % 100 == 0
    assert mined(negatives.mine(frame(spark, rows + extra), asked)) == brute_force(rows)


def test_empty_tables(spark):
    none = frame(spark, vectors(4, 10)).where("false")
    assert negatives.mine(none, F.col("vec_id") % 100 == 0).count() == 0
    some = frame(spark, vectors(4, 10))
    assert negatives.mine(some, F.lit(False)).count() == 0


def test_without_a_file_system_of_its_own(spark, monkeypatch):
    rows = vectors(5, 300)
    monkeypatch.setattr(chunks, "_readable", lambda uri: False)
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, anchor_bytes=2000)
    assert mined(got) == brute_force(rows)


def test_query_moves_labels(spark, tmp_path):
    rows = vectors(6, 500)
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    assert mined(queries.QUERIES["op12_hard_negatives"](spark, str(tmp_path))) == brute_force(moved)
