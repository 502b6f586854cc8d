"""Vector search against brute force in plain Python."""

import json
import math
import random
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from findry.functions import distance as dist
from findry.functions import kernels
from findry.functions.embed import TEXT_BYTES, HashedWords, embed, hashed_word_counts, in_parts
from findry.operators import corpus as ops
from findry.operators import ivf, search, topk

SCHEMA = "id string, content string, metadata string, embedding array<double>"
QUERY = "query_id long, embedding array<double>"


def plain_sum(values):
    total = 0.0
    for v in values:
        total += v
    return total


def plain_distance(metric, a, b):
    if metric == "euclidean":
        return math.sqrt(plain_sum((x - y) * (x - y) for x, y in zip(a, b)))
    inner = plain_sum(x * y for x, y in zip(a, b))
    if metric == "dot":
        return -inner
    norms = math.sqrt(plain_sum(x * x for x in a)) * math.sqrt(plain_sum(y * y for y in b))
    return 1.0 if norms == 0 else 1.0 - inner / norms


def brute_force(rows, queries, k, metric):
    out = []
    for q, v in queries:
        near = sorted((plain_distance(metric, v, e), i) for i, e in rows)[:k]
        out += [(q, i, d, rank) for rank, (d, i) in enumerate(near, 1)]
    return out


def hard_vectors(n, dim, seed, copies=0.4):
    """Vectors of mixed scale, a third and more of them copies of one, some of them zero."""
    rng = random.Random(seed)
    one = [rng.gauss(0, 1) for _ in range(dim)]
    rows = []
    for i in range(n):
        draw = rng.random()
        if draw < copies:
            vector = list(one)
        elif draw < copies + 0.05:
            vector = [0.0] * dim
        else:
            scale = 10 ** rng.uniform(-3, 3)
            vector = [rng.gauss(0, 1) * scale for _ in range(dim)]
        rows.append((f"r{rng.randrange(10 ** 9):09d}-{i}", vector))
    return rows, one


@pytest.fixture(scope="module")
def hard(spark):
    rows, one = hard_vectors(700, 24, 3)
    queries = [(i, v) for i, (_, v) in enumerate(hard_vectors(60, 24, 4, 0.1)[0])] + [(60, one)]
    corpus = spark.createDataFrame(rows, "id string, embedding array<double>").repartition(5).cache()
    wanted = spark.createDataFrame(queries, QUERY).repartition(3).cache()
    return rows, queries, corpus, wanted


def collected(frame):
    return sorted(((r["query_id"], r["id"], r["distance"], r["rank"]) for r in frame.collect()),
                  key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("plan", ["queries travel", "table travels", "files travel"])
def test_every_plan_equals_brute_force(hard, metric, plan, monkeypatch):
    rows, queries, corpus, wanted = hard
    budget = {"queries travel": 1 << 20, "table travels": 0, "files travel": 0}[plan]
    if plan == "table travels":
        real = topk.measure
        monkeypatch.setattr(topk, "measure", lambda f, w, budget=0, per_row=0: real(
            f, w, 0 if "query_id" in f.columns else 1 << 30, per_row))
    monkeypatch.setattr(kernels, "PAIRS_AT_ONCE", 5000)
    found, most = topk.nearest_rows(corpus, wanted, 7, metric, budget=budget, block_bytes=24 * 8 * 90)
    assert most == 7 * len(queries)
    assert collected(found) == brute_force(rows, queries, 7, metric)


def test_column_distances_are_the_same_numbers(hard):
    rows, queries, corpus, _ = hard
    for metric in ("cosine", "dot", "euclidean"):
        want = [(w[1], w[2]) for w in brute_force(rows, [queries[3]], 9, metric)]
        away = dist.distance(metric, F.col("embedding"), dist.vector(queries[3][1]))
        column = corpus.select("id", away.alias("distance")).orderBy("distance", "id").limit(9)
        assert [tuple(r) for r in column.collect()] == want
        found = search.knn_single(corpus, queries[3][1], 9, metric, columns=["embedding"]).collect()
        assert [(r["id"], r["distance"]) for r in found] == want
        assert all(r["embedding"] == dict(rows)[r["id"]] for r in found)


def test_more_wanted_than_rows(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])],
                                   "id string, embedding array<double>")
    wanted = spark.createDataFrame([(1, [1.0, 0.0])], QUERY)
    assert [r["id"] for r in search.knn_join(corpus, wanted, 5).orderBy("rank").collect()] == ["a", "b"]


def test_no_queries_or_no_rows(spark):
    corpus = spark.createDataFrame([("a", [1.0])], "id string, embedding array<double>")
    wanted = spark.createDataFrame([(1, [1.0])], QUERY)
    assert search.knn_join(corpus, wanted.limit(0)).count() == 0
    assert search.knn_join(corpus.limit(0), wanted).count() == 0


def test_float_vectors_and_null_embeddings(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, embedding array<float>")
    wanted = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], QUERY)
    found = search.knn_join(corpus, wanted).collect()
    assert [(r["query_id"], r["id"], r["score"]) for r in found] == [(1, 1, 1.0)]


def test_vectors_of_unlike_length_are_refused(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0])], "id string, embedding array<double>")
    wanted = spark.createDataFrame([(1, [1.0, 0.0])], QUERY)
    with pytest.raises(Exception, match="length"):
        search.knn_join(corpus, wanted).collect()
    with pytest.raises(Exception, match="length"):
        search.knn_single(corpus, [1.0, 0.0]).collect()
    assert [r["id"] for r in ops.validate_dim(corpus, 2).collect()] == ["a"]
    assert [r["id"] for r in ops.rejected_rows(corpus, 2).collect()] == ["b"]


def test_bad_arguments(spark):
    corpus = spark.createDataFrame([("a", [1.0])], "id string, embedding array<double>")
    wanted = spark.createDataFrame([(1, [1.0])], QUERY)
    with pytest.raises(ValueError):
        search.knn_join(corpus, wanted, metric="nope")
    with pytest.raises(ValueError):
        search.knn_join(corpus, wanted, k=0)
    with pytest.raises(ValueError):
        dist.distance("nope", F.col("a"), F.col("b"))


# Hand-made corpora with known answers


def bag_corpus(spark, texts, metadatas=None, ids=None):
    rows = [(ids[i] if ids else str(i), t, json.dumps(metadatas[i] if metadatas else {}))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id string, content string, metadata string").withColumn(
        "embedding", embed(F.col("content"), HashedWords()))


def ask(spark, corpus, text, k, **options):
    wanted = spark.createDataFrame([(0, text)], "query_id long, text string")
    return search.search_text(corpus, wanted, HashedWords(), k, columns=["content", "metadata"],
                              **options).orderBy("rank").collect()


def test_every_query_text_is_embedded_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "FIRST_LOOK_ROWS", 50)
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    seen = tmp_path / "seen"
    seen.mkdir()

    def counting(texts):
        (seen / uuid.uuid4().hex).write_text(str(len(texts)))
        return HashedWords()(texts)

    queries = spark.createDataFrame([(i, f"word{i}") for i in range(120)], "query_id long, text string")
    corpus = bag_corpus(spark, [f"word{i}" for i in range(40)], [{}] * 40, [f"{i:03}" for i in range(40)])
    assert search.search_text(corpus, queries, counting, 2).count() == 240
    assert sum(int(f.read_text()) for f in seen.iterdir()) == 120


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("budget", [1 << 30, 0])
def test_vectors_that_cannot_be_ranked_hide_no_others(spark, metric, budget):
    good = [(i, [1.0, float(i)]) for i in range(12)]
    bad = [(100, [float("nan"), 1.0]), (101, [float("inf"), 1.0]), (102, None), (103, [None, 1.0]),
           (104, [-float("inf"), float("nan")])]
    asked = [(1, [1.0, 2.0]), (2, None), (3, [float("nan"), 0.0]), (4, [0.0, 1.0])]
    corpus = [spark.createDataFrame(rows, "id long, embedding array<double>") for rows in (good, good + bad)]
    wanted = [spark.createDataFrame(rows, QUERY) for rows in ([asked[0], asked[3]], asked)]
    want = topk.nearest_rows(corpus[0], wanted[0], 5, metric)[0].collect()
    for parts in (1, 4):
        got = topk.nearest_rows(corpus[1].repartition(parts), wanted[1], 5, metric, budget)[0].collect()
        assert sorted(got) == sorted(want) and len(want) == 10


def test_a_table_that_begins_with_nulls_is_measured_whole(spark, monkeypatch):
    monkeypatch.setattr(topk, "FIRST_LOOK_ROWS", 20)
    rows = spark.createDataFrame([(i, None if i < 90 else [1.0] * 50) for i in range(200)],
                                 "id long, embedding array<double>").coalesce(1)
    side = topk.measure(rows, "embedding", 10_000)
    assert side.local is None and (side.rows, side.dim) == (200, 50)


def test_a_small_sample_of_a_large_corpus_is_refused(spark):
    rows = spark.range(300).select("id", F.array(F.col("id").cast("double")).alias("embedding"))
    with pytest.raises(ValueError):
        ivf.train(rows, 50, sample=20)
    sparse = rows.select("id", F.when(F.col("id") % 50 == 0, F.col("embedding")).alias("embedding"))
    assert ivf.train(sparse, 3, sample=5, iters=2).count() == 3


SHELF = {"m1": ("rain over the harbour tonight", "weather"), "m2": ("harbour ferry timetable", "travel"),
         "m3": ("slow train through the hills", "travel"), "m4": ("bread with seeds", "kitchen")}


@pytest.fixture(scope="module")
def shelf(spark):
    return bag_corpus(spark, [t for t, _ in SHELF.values()], [{"kind": k} for _, k in SHELF.values()],
                      list(SHELF))


def by_shared_words(text, kinds):
    """Ids by cosine of plain word counts, which the hashed ones equal where no two words share a bucket."""
    asked = text.split()

    def cosine(t):
        own = t.split()
        dot = sum(asked.count(w) * own.count(w) for w in set(own))
        return dot / math.sqrt(sum(asked.count(w) ** 2 for w in set(asked))
                               * sum(own.count(w) ** 2 for w in set(own)))

    return sorted((i for i, (_, k) in SHELF.items() if k in kinds), key=lambda i: (-cosine(SHELF[i][0]), i))


@pytest.mark.parametrize("text", ["ferry from the harbour", "train hills", "seeds"])
def test_texts_rank_by_their_words(spark, shelf, text):
    hits = ask(spark, shelf, text, 4)
    words = {w for t, _ in SHELF.values() for w in t.split()} | set(text.split())
    buckets = [int(np.argmax(v)) for v in HashedWords()(sorted(words))]
    if len(set(buckets)) == len(words):
        assert [h["id"] for h in hits] == by_shared_words(text, {"weather", "travel", "kitchen"})
    assert hits[0]["id"] == by_shared_words(text, {"weather", "travel", "kitchen"})[0]
    scores = [h["score"] for h in hits]
    assert scores == sorted(scores, reverse=True)
    assert json.loads(hits[0]["metadata"])["kind"] == SHELF[hits[0]["id"]][1]


def test_filters_apply_before_the_choice(spark, shelf):
    hits = ask(spark, shelf, "rain and bread", 2, filter={"kind": "travel"})
    assert {h["id"] for h in hits} == {"m2", "m3"}
    assert ask(spark, shelf, "rain", 3, filter={"kind": "sports"}) == []


def test_relevance_of_vectors_of_length_one(spark):
    angles = np.random.default_rng(12).uniform(0, 2 * math.pi, 40)
    rows = [(f"t{i:02}", [math.cos(a), math.sin(a)]) for i, a in enumerate(angles)]
    corpus = spark.createDataFrame(rows, "id string, embedding array<double>")
    asked = spark.createDataFrame([(9, [0.6, 0.8])], QUERY)

    def relevance(metric):
        found = search.with_relevance(search.knn_join(corpus, asked, 40, metric), metric)
        return {r["id"]: r["relevance"] for r in found.collect()}

    toward = {i: 0.6 * x + 0.8 * y for i, (x, y) in rows}
    assert relevance("cosine") == pytest.approx({i: max(0.0, c) for i, c in toward.items()}, abs=1e-9)
    assert relevance("dot") == pytest.approx(relevance("cosine"), abs=1e-9)
    far = {i: 1 / (1 + math.sqrt(max(0.0, 2 - 2 * c))) for i, c in toward.items()}
    assert relevance("euclidean") == pytest.approx(far, abs=1e-6)


def test_relevance_maps(spark):
    scores = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (3.5,)], "score double")
    far = [r[0] for r in scores.select(dist.relevance("euclidean", F.col("score"))).collect()]
    assert far == [1.0, 0.5, 1 / 3, 1.0]
    cosine = [r[0] for r in scores.select(dist.relevance("cosine", F.col("score"))).collect()]
    assert cosine == [1.0, 0.0, 0.0, 1.0]
    dot = [r[0] for r in scores.select(dist.relevance("dot", F.col("score"))).collect()]
    assert dot == [0.0, 0.0, 0.0, 1.0]
    assert scores.select(dist.score(F.lit(0.25))).first()[0] == 0.75


def test_embedder_and_native_counts_agree(spark):
    texts = [(1, "Hello, hello WORLD 42"), (2, ""), (3, "çà et là 42x"), (4, None)]
    table = spark.createDataFrame(texts, "id long, text string")
    dense = {r["id"]: r["v"] for r in table.select(
        "id", embed(F.col("text"), HashedWords()).alias("v")).collect()}
    counts = {(r["id"], r["bucket"]): r["n"] for r in hashed_word_counts(table, "id", "text").collect()}
    assert counts == {(i, b): n for i, v in dense.items() for b, n in enumerate(v) if n}
    assert sum(dense[1]) == 4 and sum(dense[2]) == 0 and sum(dense[4]) == 0


def test_kernel_copies_do_not_pile_up():
    """However many rows tie, a task keeps k of them, the lowest ids."""
    import pyarrow as pa

    best = kernels.NearestVectors(np.ones((2, 3)), 4, "cosine")
    for block in range(20):
        ids = pa.array([f"{(i * 7919 + block) % 100000:06d}" for i in range(1000)])
        best.add(np.ones((1000, 3)), ids)
        assert best.kept.num_rows == 8
    every = sorted(f"{(i * 7919 + b) % 100000:06d}" for b in range(20) for i in range(1000))
    assert best.result()[1].to_pylist() == every[:4] * 2


def test_an_embedder_is_given_texts_in_bounded_parts(spark):
    texts = pa.array(["word " * 40, None, "", "é" * 5000, "a b c"] * 50 + [""] * 300, pa.string())
    parts = list(in_parts(texts, 1000))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) == 1 or pc.sum(pc.binary_length(p)).as_py() <= 1000 for p in parts)
    assert max(map(len, parts)) <= 1000 // 64
    assert list(in_parts(pa.array([], pa.string()))) == []

    class Watched(HashedWords):
        def __call__(self, some):
            if sum(len(t) for t in some) > TEXT_BYTES and len(some) > 1:
                raise ValueError("too much text at once")
            return super().__call__(some)

    rows = spark.createDataFrame([(i, f"w{i} " * 100_000) for i in range(12)], "id long, text string").coalesce(1)
    got = {r["id"]: r["v"] for r in rows.select("id", embed(F.col("text"), Watched()).alias("v")).collect()}
    for i, row in got.items():
        assert row == HashedWords()([f"w{i} " * 100_000])[0].tolist()
