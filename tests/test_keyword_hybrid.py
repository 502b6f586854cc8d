"""Keyword search, fusion, diversity and context against plain Python."""

import json
import math
import random
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from findry.functions import kernels
from findry.functions.text import STOP_WORDS
from findry.operators import hybrid, keyword, mmr, topk
from findry.operators.context import assemble_context
from findry.sources import storage
from findry.sources.embeddings import embed_cached


def split(text):
    return re.findall(r"[a-z0-9]+", (text or "").lower())


def overlap_ranking(docs, queries, k):
    out = []
    for q, text in queries:
        words = set(split(text))
        scored = [(-len(words & set(split(c))), i) for i, c in docs]
        near = sorted(s for s in scored if s[0])[:k]
        out += [(q, i, -s, r) for r, (s, i) in enumerate(near, 1)]
    return out


def tfidf_ranking(docs, queries, k):
    def kept(text):
        return [w for w in split(text) if len(w) >= 3 and w not in STOP_WORDS]

    frequency = Counter(w for _, c in docs for w in set(kept(c)))
    counts = {i: Counter(kept(c)) for i, c in docs}
    out = []
    for q, text in queries:
        scored = []
        for i, _ in docs:
            shared = sorted(set(kept(text)) & set(counts[i]))
            if shared:
                score = 0.0
                for w in shared:
                    held = frequency[w]
                    idf = math.log10(len(docs) / held) if held < len(docs) else math.log10(1.0001)
                    score += counts[i][w] * idf ** 2
                scored.append((-score, i))
        out += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    rare = [f"word{i}" for i in range(150)]
    docs = []
    for i in range(300):
        # One word is in nearly every document; a third of the documents are copies.
        words = ["common"] * rng.randrange(0, 4) + rng.choices(rare, k=rng.randrange(0, 25)) + ["the"]
        docs.append((i, "Copy of word3 word3 common, again!" if i % 3 == 0 else " ".join(words)))
    queries = [(i, " ".join(["common"] + rng.choices(rare + ["the", "of", "x9", "unseen"], k=6)))
               for i in range(40)] + [(40, ""), (41, "unseen the"), (42, "copy")]
    corpus = spark.createDataFrame(
        [(i, c, json.dumps({"even": i % 2 == 0})) for i, c in docs],
        "id long, content string, metadata string").repartition(4).cache()
    wanted = spark.createDataFrame(queries, "query_id long, text string").cache()
    return docs, queries, corpus, wanted


def collected(frame):
    return sorted((r["query_id"], r["id"], r["score"], r["rank"]) for r in frame.collect())


def same(got, want):
    got, want = sorted(got, key=lambda r: (r[0], r[3])), sorted(want, key=lambda r: (r[0], r[3]))
    assert [(g[0], g[3]) for g in got] == [(w[0], w[3]) for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-12)
    assert [g[1] for g in got] == [w[1] for w in want]


@pytest.mark.parametrize("scorer,ranking", [("overlap", overlap_ranking), ("tfidf", tfidf_ranking)])
@pytest.mark.parametrize("indexed", [False, True])
@pytest.mark.parametrize("blocks", [False, True])
def test_ranking(texts, tmp_path, monkeypatch, scorer, ranking, indexed, blocks):
    docs, queries, corpus, wanted = texts
    index = None
    if indexed:
        storage.write_postings(keyword.postings(corpus), str(tmp_path / "p"))
        index = storage.read_postings(corpus.sparkSession, str(tmp_path / "p"))
    monkeypatch.setattr(kernels, "PAIRS_AT_ONCE", 700)
    if blocks:
        monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(topk, "BLOCK_BYTES", 20_000)
    found = keyword.keyword_search(corpus, wanted, 6, scorer=scorer, index=index)
    same(collected(found), ranking(docs, queries, 6))


@pytest.mark.parametrize("indexed", [False, True])
def test_filter_and_columns(texts, indexed):
    docs, queries, corpus, wanted = texts
    index = keyword.postings(corpus) if indexed else None
    found = keyword.keyword_search(corpus, wanted, 3, {"even": True}, index=index,
                                   columns=["content"])
    same(collected(found), overlap_ranking([d for d in docs if d[0] % 2 == 0], queries, 3))
    assert all(r["content"] == dict(docs)[r["id"]] for r in found.collect())


def test_word_in_every_document_still_ranks(spark):
    corpus = spark.createDataFrame([(1, "gravel and dust"), (2, "gravel over gravel")], "id long, content string")
    wanted = spark.createDataFrame([(1, "gravel")], "query_id long, text string")
    found = keyword.keyword_search(corpus, wanted, scorer="tfidf").orderBy("rank").collect()
    assert [r["id"] for r in found] == [2, 1] and found[1]["score"] > 0
    assert found[0]["score"] == pytest.approx(2 * found[1]["score"])


@pytest.mark.parametrize("indexed", [False, True])
def test_words_of_any_script(spark, indexed):
    corpus = spark.createDataFrame([(1, "une étude de cas"), (2, "tude"), (3, "教育部門 の 報告"), (4, "x")],
                                   "id long, content string")
    wanted = spark.createDataFrame([(1, "Étude"), (2, "教育部門")], "query_id long, text string")
    index = keyword.postings(corpus) if indexed else None
    found = keyword.keyword_search(corpus, wanted, scorer="tfidf", index=index).collect()
    assert sorted((r["query_id"], r["id"]) for r in found) == [(1, 1), (2, 3)]


def test_only_the_folders_of_the_query_words_are_read(spark, tmp_path):
    corpus = spark.createDataFrame(
        [(i, f"word{i} word{i + 1}") for i in range(100)], "id long, content string")
    for _ in range(2):
        index = storage.ensure_postings(corpus, str(tmp_path / "p"))
        assert index.count() == 200
    wanted = spark.createDataFrame([(1, "word7")], "query_id long, text string")
    found = keyword.keyword_search(corpus, wanted, index=index)
    assert [r["id"] for r in found.collect()] == [6, 7]
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().toString()


def test_unknown_scorer(texts):
    with pytest.raises(ValueError):
        keyword.keyword_search(texts[2], texts[3], scorer="nope")


# Fusion


# Place by vector and by words of six documents (no word in common: none).
PLACES = {"p": (1, None), "q": (2, 2), "r": (3, 1), "s": (4, None), "t": (5, 3), "u": (6, None)}


@pytest.fixture(scope="module")
def mixed(spark):
    texts = {"p": "granite cliff", "q": "tin mine lamp", "r": "copper kettle lamp oven tin",
             "s": "violet", "t": "oven tin", "u": "moss"}
    corpus = spark.createDataFrame(
        [(i, texts[i], json.dumps({"dry": i in "pqt"}), [math.cos(0.2 * v), math.sin(0.2 * v)])
         for i, (v, _) in PLACES.items()],
        "id string, content string, metadata string, embedding array<double>")
    wanted = spark.createDataFrame([(7, "oven tin lamp copper", [1.0, 0.0])],
                                   "query_id long, text string, embedding array<double>")
    return corpus, wanted


def fused(mixed, **options):
    return hybrid.hybrid_search(*mixed, **{"k": 6, **options}).orderBy("rank").collect()


def by_hand(weight, ids=PLACES):
    near = {i: n for n, i in enumerate(sorted(ids, key=lambda i: PLACES[i][0]), 1)}
    said = [i for i in ids if PLACES[i][1]]
    said = {i: n for n, i in enumerate(sorted(said, key=lambda i: PLACES[i][1]), 1)}
    score = {i: weight / (60 + near[i]) + ((1 - weight) / (60 + said[i]) if i in said else 0) for i in ids}
    return sorted(score.items(), key=lambda x: (-x[1], near[x[0]]))


@pytest.mark.parametrize("weight", [0.0, 0.25, 0.5, 1.0])
def test_the_blend_follows_both_rankings(mixed, weight):
    got = [(r["id"], r["score"]) for r in fused(mixed, vector_weight=weight)]
    want = by_hand(weight)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want])


def test_filter_applies_to_both_sides(mixed):
    got = [r["id"] for r in fused(mixed, filter={"dry": True})]
    assert got == [i for i, _ in by_hand(0.5, [i for i in PLACES if i in "pqt"])]


@pytest.mark.parametrize("weight", [1.5, -0.1])
def test_weight_out_of_range(mixed, weight):
    with pytest.raises(ValueError):
        fused(mixed, vector_weight=weight)


def test_contents_come_along(mixed):
    hits = fused(mixed, columns=["content", "metadata"])
    assert (hits[0]["id"], hits[0]["content"]) == ("r", "copper kettle lamp oven tin")
    assert json.loads(hits[0]["metadata"]) == {"dry": False}


def test_fusion_ties(spark):
    ranked = "query_id long, id string, rank int"
    vector = spark.createDataFrame([(1, "a", 1), (1, "c", 2)], ranked)
    words = spark.createDataFrame([(1, "b", 1), (1, "d", 2), (1, "c", 3)], ranked)
    got = hybrid.rrf_fuse(vector, words, 10).orderBy("rank").collect()
    assert [r["id"] for r in got] == ["c", "a", "b", "d"]


# Diversity and context


def test_diversity_beats_copies(spark):
    corpus = spark.createDataFrame(
        [(n, [1.0, 0.1, 0.0]) for n in range(5)] + [(9, [0.3, 0.0, 1.0])], "id long, embedding array<double>")
    wanted = spark.createDataFrame([(1, [1.0, 0.0, 0.2])], "query_id long, embedding array<double>")
    got = mmr.mmr(corpus, wanted, 2, 6, 0.3).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 9]


def plain_diverse(query, candidates, k, balance):
    def cos(a, b):
        norms = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return 0.0 if norms == 0 else sum(x * y for x, y in zip(a, b)) / norms

    taken, left = [], list(range(len(candidates)))
    while left and len(taken) < k:
        gains = [balance * cos(query, candidates[i])
                 - (1 - balance) * max((cos(candidates[i], candidates[j]) for j in taken), default=0.0)
                 for i in left]
        taken.append(left.pop(gains.index(max(gains))))
    return taken


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_diverse_picks(spark, metric):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)]
    queries = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(12)]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>")
    wanted = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    near, _ = topk.nearest_rows(corpus, wanted, 15, metric)
    lists = {}
    for r in near.orderBy("query_id", "rank").collect():
        lists.setdefault(r["query_id"], []).append(r["id"])
    got = {}
    for r in mmr.mmr(corpus, wanted, 6, 15, 0.4, metric).orderBy("query_id", "rank").collect():
        assert lists[r["query_id"]][r["near_rank"] - 1] == r["id"]
        got.setdefault(r["query_id"], []).append(r["id"])
    vectors = dict(rows)
    for q, v in queries:
        picks = plain_diverse(v, [vectors[i] for i in lists[q]], 6, 0.4)
        assert got[q] == [lists[q][i] for i in picks]


def test_fewer_fetched_than_wanted(spark):
    corpus = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)],
                                   "id long, embedding array<double>")
    wanted = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert mmr.mmr(corpus, wanted, 5, 3).count() == 3


def test_context(spark):
    results = spark.createDataFrame(
        [(1, 2, "second"), (1, 1, "first"), (2, 1, "other"), (1, 10, "last")],
        "query_id long, rank int, content string")
    got = {r["query_id"]: r["context"] for r in assemble_context(results).collect()}
    assert got == {1: "first\nsecond\nlast", 2: "other"}


def test_no_more_cells_than_matches():
    rng = np.random.default_rng(5)
    vocab = [f"w{i:03d}" for i in range(60)]
    docs = [[vocab[j] for j in rng.choice(60, rng.integers(1, 5))] for _ in range(500)]
    queries = [sorted({vocab[j] for j in rng.choice(60, 2)}) for _ in range(200)]
    asked = pa.table({"terms": queries, "weights": [[1.0] * len(q) for q in queries]})
    best = kernels.BestMatches(keyword._query_terms(asked), 3)
    row = np.repeat(np.arange(500), [len(d) for d in docs])
    best.add(pa.array(np.arange(500)), row, pa.array([w for d in docs for w in d]), None)
    matches = [(q, d) for q, ws in enumerate(queries) for d, held in enumerate(docs) if set(ws) & set(held)]
    assert best.cells == len(matches) < 500 * 200 / 5
    found = {}
    for q, d, away in zip(*(x if isinstance(x, np.ndarray) else x.to_numpy() for x in best.result())):
        found.setdefault(int(q), []).append((away, d))
    for q, ws in enumerate(queries):
        scored = sorted((-float(sum(docs[d].count(w) for w in ws)), d) for p, d in matches if p == q)
        assert sorted(found.get(q, [])) == scored[:3]


def test_diversity_of_many_queries_at_once(monkeypatch):
    rng = np.random.default_rng(7)
    sizes = np.array([5, 0, 3, 9, 1])
    candidates = np.zeros((5, 9, 4))
    for q, n in enumerate(sizes):
        candidates[q, :n] = rng.normal(size=(n, 4))
    queries = rng.normal(size=(5, 4))
    got = kernels.diverse(queries, candidates, sizes, 4, 0.6)
    assert got == [plain_diverse(queries[q], candidates[q, :n].tolist(), 4, 0.6) for q, n in enumerate(sizes)]


@pytest.mark.parametrize("budget", [1, 4_000_000])
def test_picks_do_not_depend_on_how_queries_are_batched(spark, monkeypatch, budget):
    monkeypatch.setattr(kernels, "PAIRS_AT_ONCE", budget)
    rng = random.Random(3)
    corpus = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(40)],
                                   "id long, embedding array<double>")
    wanted = corpus.withColumnRenamed("id", "query_id").where("query_id < 20")
    got = mmr.mmr(corpus, wanted, 3, 10, 0.5).select("query_id", "rank", "id").collect()
    assert len(got) == 60 and all(r["id"] == r["query_id"] for r in got if r["rank"] == 1)


def test_unchanged_texts_are_not_embedded_again(spark, tmp_path):
    asked, path = tmp_path / "asked", str(tmp_path / "cache")
    asked.mkdir()
    folder = str(asked)

    def embedder(texts):
        # What it is asked goes to files, as it runs in other processes.
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            json.dump(list(texts), out)
        return [[float(len(t)), 1.0] for t in texts]

    def seen():
        return Counter(t for f in asked.iterdir() for t in json.loads(f.read_text()))

    rows = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a"), (4, None), (5, "")], "id long, content string")
    more = rows.unionByName(spark.createDataFrame([(6, "ccc"), (7, "bb")], rows.schema))
    for frame, counts in ((rows, 3), (more, 4), (more.withColumn("embedding", F.lit(None)), 4)):
        got = {r["id"]: r["embedding"] for r in embed_cached(frame, embedder, path).collect()}
        assert got == {r["id"]: [float(len(r["content"] or "")), 1.0] for r in frame.collect()}
        assert len(seen()) == counts and set(seen().values()) == {1}
    assert embed_cached(rows.limit(0), embedder, str(tmp_path / "none")).count() == 0
