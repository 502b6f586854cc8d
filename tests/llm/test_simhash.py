"""Fingerprints and groups against their definitions."""

import random
import re

import numpy as np
import pytest
import xxhash

from findry.llm import simhash
from findry.llm.components import components
from findry.llm.scratch import Scratch
from tests.llm.data import no_documents, odd_documents, prose


def plain_fingerprint(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    found = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(values):
    """Least index reachable by links of at most four differing bits."""
    least = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(values):
            for j, y in enumerate(values):
                if (x ^ y).bit_count() <= 4 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_fingerprint_is_the_majority_of_shingle_hashes():
    rnd = random.Random(1)
    for text in [None, "", "\t \n", "a", "A b c", "One TWO Été four five", "x " * 500,
                 *(prose(rnd, n) for n in range(1, 30))]:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_no_pair_within_the_radius_is_missed():
    rnd = random.Random(2)
    for _ in range(3000):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in simhash.masks())
    assert len(simhash.masks()) == 31


def test_bucket_forest_connects_what_all_pairs_connect(monkeypatch):
    rnd = random.Random(5)
    for limit in (3, 10_000):
        monkeypatch.setattr(simhash, "SPLIT", limit)
        values = {rnd.getrandbits(64) for _ in range(10)}
        for v in list(values):
            for _ in range(rnd.randint(0, 9)):
                for bit in rnd.sample(range(64), rnd.randint(1, 4)):
                    v ^= 1 << bit
                values.add(v)
        values = sorted(values)
        links = simhash.spanning_links(np.array(values, np.uint64))
        least = list(range(len(values)))
        for _ in values:
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        assert least == plain_groups(values)
        assert len(links) == len(values) - len(set(least))


def test_documents_get_their_groups(spark):
    rnd = random.Random(4)
    base = [prose(rnd, 40) for _ in range(6)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        parts = t.split()
        for k in range(8):
            parts[rnd.randrange(len(parts))] = f"w{k}"
            rows.append((rnd.randrange(1000, 10**6), " ".join(parts)))
    rows += [(7, ""), (5, None), (900, base[0]), (3, base[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"])
           for r in simhash.near_duplicates(docs).collect()}
    order = sorted(rows)
    values = [plain_fingerprint(t) for _, t in order]
    least = plain_groups(values)
    assert got == {d: (v, order[m][0]) for (d, _), v, m in zip(order, values, least)}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[1] == by[2] == by[3] == {1} and by[4] == by[5] == by[6] == {4}
    assert by[10] == by[11] == {10}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect())
    assert ids == [0, 0, 1, 4, 7, 7, 8, 9, 10, 12, 13]
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    assert simhash.keep_one(no_documents(spark)).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rnd = random.Random(9)
    n = 60
    if shape == "path":
        order = rnd.sample(range(n), n)
        pairs = list(zip(order, order[1:]))
    elif shape == "star":
        pairs = [(30, i) for i in range(n)]
    else:
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(40)]
    least = {x: x for p in pairs for x in p}
    for _ in range(n):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, Scratch(spark, "test")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: least[x] for x in linked}
