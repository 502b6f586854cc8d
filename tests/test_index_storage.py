"""The list index, stored corpora, the collection and streaming ingest."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from findry.collection import Collection
from findry.functions.embed import HashedWords
from findry.operators import corpus as ops
from findry.operators import ivf, keyword, search, topk
from findry.schema import Columns, corpus_from_columns
from findry.sources import storage
from findry.streaming.ingest import stream_into

SCHEMA = "id string, content string, metadata string, embedding array<double>"
DIM, CENTRES = 12, 6
SIZES = [90, 25, 40, 31, 60, 17]


@pytest.fixture(scope="module")
def blobs(spark):
    """Six groups of unlike size along the axes of a turned frame."""
    rnd = np.random.default_rng(20)
    axes = np.linalg.qr(rnd.normal(size=(DIM, DIM)))[0][:CENTRES]
    group = np.repeat(np.arange(CENTRES), SIZES)
    points = axes[group] * rnd.uniform(0.8, 1.2, (len(group), 1)) + rnd.normal(0, 0.06, (len(group), DIM))
    order = rnd.permutation(len(group))
    rows = [(f"v{n:03}", f"group {group[i]}", "{}", points[i].tolist()) for n, i in enumerate(order)]
    corpus = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    asked = axes[rnd.integers(CENTRES, size=24)] + rnd.normal(0, 0.06, (24, DIM))
    wanted = spark.createDataFrame(list(enumerate(asked.tolist())),
                                   "query_id long, embedding array<double>").cache()
    index = ivf.build_index(corpus, CENTRES, nprobe=3, iters=15)
    index = ivf.Index(index.centroids.cache(), index.rows.cache(), index.nprobe)
    return axes.tolist(), corpus, wanted, index


def recall(corpus, wanted, index, nprobe):
    exact = search.knn_join(corpus, wanted, 10)
    found = search.knn_join(index.rows, wanted, 10, centroids=index.centroids, nprobe=nprobe)
    return ivf.recall(found, exact).first()["recall"]


def test_all_lists_are_exact(blobs):
    _, corpus, wanted, index = blobs
    assert recall(corpus, wanted, index, CENTRES) == 1.0
    assert recall(corpus, wanted, index, 10 * CENTRES) == 1.0


def test_few_lists_keep_recall(blobs):
    _, corpus, wanted, index = blobs
    assert recall(corpus, wanted, index, 3) >= 0.75
    probes = ivf.probe(wanted, index.centroids, 3)
    scanned = ivf.scan_fraction(index.rows, probes).agg(F.avg("fraction")).first()[0]
    assert 0.2 < scanned < 0.75


def test_every_plan_of_a_probed_search_agrees(blobs, monkeypatch):
    _, _, wanted, index = blobs
    probed = ivf.probe(wanted, index.centroids, 2)
    rows = index.rows.select("id", "embedding", "cluster")
    want = sorted(topk.nearest_rows(rows, probed, 10, "euclidean")[0].collect())
    blocks = topk.nearest_rows(rows, probed, 10, "euclidean", budget=0, block_bytes=DIM * 8 * 15)
    assert sorted(blocks[0].collect()) == want
    real = topk.measure
    monkeypatch.setattr(topk, "measure", lambda f, w, budget=0, per_row=0: real(
        f, w, 0 if "query_id" in f.columns else 1 << 30, per_row))
    assert sorted(topk.nearest_rows(rows, probed, 10, "euclidean")[0].collect()) == want


def test_many_centroids_are_not_broadcast(blobs, monkeypatch):
    _, corpus, wanted, index = blobs
    want = sorted(index.rows.select("id", "cluster").collect())
    probes = sorted(ivf.probe(wanted, index.centroids, 3).select("query_id", "clusters").collect())
    monkeypatch.setattr(ivf, "_local", lambda c: (None, None))
    assert sorted(ivf.assign(corpus, index.centroids).select("id", "cluster").collect()) == want
    assert sorted(ivf.probe(wanted, index.centroids, 3).select("query_id", "clusters").collect()) == probes


def test_kmeans_step_keeps_empty_lists(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0])], "id long, embedding array<double>")
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [9.0, 9.0]), (2, [1.0, 0.0])],
                                      ivf.CENTROID_SCHEMA)
    moved = {r["cid"]: r["centroid"] for r in ivf.kmeans_step(rows, centroids).collect()}
    # Equally near lists: the lowest number takes the rows.
    assert moved == {0: [1.0, 0.0], 1: [9.0, 9.0], 2: [1.0, 0.0]}
    near = spark.createDataFrame([(0, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [8.0, 0.0])],
                                 ivf.CENTROID_SCHEMA)
    moved = {r["cid"]: r["centroid"] for r in ivf.kmeans_step(rows, near).collect()}
    assert moved == {0: [1.0, 0.0], 1: [0.5, 0.0], 2: [8.0, 0.0]}


def test_fewer_rows_than_lists(spark):
    rows = spark.createDataFrame([(1, [0.0]), (2, [5.0])], "id long, embedding array<double>")
    centres = ivf.train(rows, 100).collect()
    assert sorted(r["centroid"] for r in centres) == [[0.0], [5.0]]


def test_training_sample_is_exact_and_repeatable(spark):
    rows = spark.range(5000).select("id", F.array(F.col("id").cast("double")).alias("embedding"))
    want = {r["id"] for r in rows.select("id", ivf._seeded("id", 3).alias("h"))
            .orderBy("h", "id").limit(400).collect()}
    for parts in (1, 7):
        got = ivf.training_sample(rows.repartition(parts), 400, 3)
        assert {r["id"] for r in got.collect()} == want
    assert ivf.training_sample(rows, 5000, 3).count() == 5000


def test_empty_corpus_and_bad_sizes(spark, blobs):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        ivf.build_index(empty)
    for bad in ({"n_lists": 0}, {"sample": 0}, {"nprobe": 0}):
        with pytest.raises(ValueError):
            ivf.build_index(blobs[1], **bad)
    with pytest.raises(ValueError):
        ivf.probe(blobs[2], blobs[3].centroids, -1)


def test_default_probes(blobs):
    _, _, wanted, index = blobs
    for n in (None, 0):
        sizes = ivf.probe(wanted, index.centroids, n, 5).select(F.size("clusters")).distinct().collect()
        assert [r[0] for r in sizes] == [5]


def test_rows_without_vector_or_list_are_invisible(spark, blobs):
    _, _, _, index = blobs
    rows = spark.createDataFrame([("x", "", "{}", None), ("y", "", "{}", [1.0] * DIM)], SCHEMA)
    lists = {r["id"]: r["cluster"] for r in ivf.assign(rows, index.centroids).collect()}
    assert lists["x"] is None and lists["y"] is not None
    unlisted = rows.withColumn("cluster", F.lit(None).cast("int"))
    wanted = spark.createDataFrame([(0, [1.0] * DIM)], "query_id long, embedding array<double>")
    assert search.knn_join(unlisted, wanted, centroids=index.centroids).count() == 0


# Stored corpora


def stored(spark, path):
    return {r["id"]: (r["content"], r["cluster"]) for r in storage.read_rows(spark, path).collect()}


def test_index_round_trip_and_pruning(spark, blobs, tmp_path):
    _, corpus, wanted, index = blobs
    path = str(tmp_path / "ix")
    assert storage.read_index(spark, path) is None
    storage.write_index(index, path, rows_per_file=15)
    back = storage.read_index(spark, path)
    assert [r["cid"] for r in back.centroids.collect()] == list(range(CENTRES))
    assert sorted(back.rows.select("id", "cluster").collect()) == sorted(
        index.rows.select("id", "cluster").collect())
    # A list of 90 rows at 15 a file is spread over several files.
    files = [list(f.glob("*.parquet")) for f in (tmp_path / "ix" / "rows").glob("*/cluster=*")]
    assert max(map(len, files)) > 3
    one = wanted.filter("query_id = 0")
    found = search.knn_join(back.rows, one, 10, centroids=back.centroids, nprobe=1)
    assert found.count() == 10
    assert re.search(r"PartitionFilters: \[[^\]]*isnotnull\(cluster", found._jdf.queryExecution().toString())


def test_upserts_move_rows_between_lists(spark, blobs, tmp_path):
    centres, corpus, _, index = blobs
    path = str(tmp_path / "ix")
    storage.write_index(index, path)
    before = stored(spark, path)
    lists = [r["clusters"][0] for r in ivf.probe(
        spark.createDataFrame(list(enumerate(centres)), "query_id long, embedding array<double>"),
        index.centroids, 1).orderBy("query_id").collect()]
    new = spark.createDataFrame([("nd", "new", "{}", centres[0])], SCHEMA)
    storage.upsert_rows(spark, path, new)
    assert stored(spark, path) == {**before, "nd": ("new", lists[0])}
    # The same id moves to the list of its new vector; repeating the batch changes nothing.
    for _ in range(2):
        storage.upsert_rows(spark, path, new.withColumn(
            "embedding", F.lit(centres[3]).cast("array<double>")))
        assert stored(spark, path) == {**before, "nd": ("new", lists[3])}
    wanted = spark.createDataFrame([(0, centres[3])], "query_id long, embedding array<double>")
    rows, centroids = storage.read_rows(spark, path), storage.read_centroids(spark, path)
    found = search.knn_join(rows, wanted, 300, centroids=centroids, nprobe=1)
    assert "nd" in {r["id"] for r in found.collect()}
    # Emptying a list leaves no row of it behind.
    gone = [i for i, (_, c) in before.items() if c == lists[5]]
    storage.delete_rows(spark, path, ops.request(spark, gone).select("id"))
    assert stored(spark, path) == {**{i: v for i, v in before.items() if i not in gone},
                                   "nd": ("new", lists[3])}
    storage.delete_matching(spark, path, {})
    storage.delete_matching(spark, path, {"x": {"$eq": 1}})
    assert len(stored(spark, path)) == len(before) - len(gone) + 1


def test_float_vectors_stay_floats(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", "{}", [1.0, 0.5])], SCHEMA).withColumn(
        "embedding", F.col("embedding").cast("array<float>"))
    path = str(tmp_path / "f")
    storage.write_rows(rows, path)
    storage.upsert_rows(spark, path, spark.createDataFrame([("b", "y", "{}", [0.25, 2.0])], SCHEMA))
    back = storage.read_rows(spark, path)
    assert back.schema["embedding"].dataType.simpleString() == "array<float>"
    assert {r["id"]: r["embedding"] for r in back.collect()} == {"a": [1.0, 0.5], "b": [0.25, 2.0]}


def test_stream_keeps_the_index_current(spark, blobs, tmp_path):
    centres, _, _, index = blobs
    path = str(tmp_path / "ix")
    storage.write_index(index, path)
    n = storage.read_rows(spark, path).count()
    source = str(tmp_path / "in")
    batch = spark.createDataFrame(
        [("s1", "one", "{}", centres[1]), ("v000", "moved", "{}", centres[2])], SCHEMA)
    batch.write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source).withColumn("at", F.length("content"))
    with pytest.raises(ValueError):
        stream_into(stream, path, str(tmp_path / "cp"))
    for _ in range(2):
        stream_into(stream, path, str(tmp_path / "cp"), order_by="at").awaitTermination()
        batch.write.mode("append").parquet(source)
    rows = storage.read_rows(spark, path)
    assert rows.count() == n + 1
    assert rows.filter("id = 'v000'").first()["content"] == "moved"


# Corpus operators


@pytest.fixture()
def small(spark):
    return spark.createDataFrame([("1", "one", '{"doc": "x"}'), ("2", "two", '{"doc": "x"}'),
                                  ("3", "three", '{"doc": "y"}')],
                                 "id string, content string, metadata string")


def test_upsert(spark, small):
    batch = spark.createDataFrame([("2", "zwei", 1), ("4", "vier", 1), ("2", "deux", 2)],
                                  "id string, content string, at int")
    got = {r["id"]: (r["content"], r["metadata"]) for r in ops.upsert(small, batch, "at").collect()}
    assert got == {"1": ("one", '{"doc": "x"}'), "2": ("deux", '{"doc": "x"}'),
                   "3": ("three", '{"doc": "y"}'), "4": ("vier", None)}
    by_place = ops.upsert(small, batch.drop("at").coalesce(1)).collect()
    assert {r["id"]: r["content"] for r in by_place}["2"] == "deux"


def test_get_and_delete(spark, small):
    got = ops.get_by_ids(small, ops.request(spark, ["3", "nope", "1", "3"])).collect()
    assert [(r["position"], r["id"], r["content"]) for r in got] == [
        (0, "3", "three"), (2, "1", "one"), (3, "3", "three")]
    assert [r["id"] for r in ops.delete(small, ["1", "2"]).collect()] == ["3"]
    assert [r["id"] for r in ops.delete(small, ["3"], {"doc": "x"}).collect()] == ["3"]
    assert ops.delete(small, []).count() == 3 and ops.delete(small, None, {}).count() == 3


def test_defaults(spark):
    rows = spark.createDataFrame([(None, "a", None), ("k", "b", '{"x": 1}')],
                                 "id string, content string, metadata string")
    got = ops.with_defaults(rows).orderBy("content").collect()
    assert len(got[0]["id"]) == 36 and got[0]["metadata"] == "{}"
    assert (got[1]["id"], got[1]["metadata"]) == ("k", '{"x": 1}')
    twice = [ops.with_defaults(rows, "content").orderBy("content").first()["id"] for _ in range(2)]
    assert twice[0] == twice[1] and len(twice[0]) == 64


def test_columns_of_an_existing_table(spark):
    table = spark.createDataFrame([("d", "text", [1.0])], "doc_id string, body string, vec array<double>")
    row = corpus_from_columns(table, Columns(id="doc_id", content="body", embedding="vec")).first()
    assert (row["id"], row["content"], row["metadata"], row["embedding"]) == ("d", "text", None, [1.0])
    with pytest.raises(ValueError):
        Columns(id="docs; DROP TABLE users")
    with pytest.raises(ValueError):
        corpus_from_columns(table)


def test_vectors_as_json(spark):
    table = spark.createDataFrame([("[1, 2.5, 3]",), ("junk",), (None,)], "t string")
    got = [r[0] for r in table.select(ops.vector_from_json(F.col("t"))).collect()]
    assert got == [[1.0, 2.5, 3.0], None, None]
    back = table.limit(1).select(ops.vector_to_json(ops.vector_from_json(F.col("t")))).first()[0]
    assert json.loads(back) == [1.0, 2.5, 3.0]


# Collection


LETTERS = {"k1": ("amber lantern", "light"), "k2": ("amber beads", "craft"),
           "k3": ("winter orchard", "farm"), "k4": ("orchard ladder repair", "farm")}


def letters(spark, path, **options):
    return Collection.from_texts(spark, str(path), [t for t, _ in LETTERS.values()], HashedWords(),
                                 [{"theme": k, "n": i} for i, (_, k) in enumerate(LETTERS.values())],
                                 ids=list(LETTERS), **options)


def test_collection(spark, tmp_path):
    made = letters(spark, tmp_path / "c")
    assert made.add_texts([]) == []
    first = made.similarity_search("winter orchard", 1).first()
    assert (first["id"], first["content"], first["score"]) == ("k3", "winter orchard", pytest.approx(1.0))
    assert json.loads(first["metadata"]) == {"theme": "farm", "n": 2}
    farm = made.similarity_search("orchard", 4, {"theme": "farm", "n": {"$gte": 2}}).collect()
    assert {r["id"] for r in farm} == {"k3", "k4"}
    assert made.hybrid_search("ladder repair", 1).first()["id"] == "k4"
    assert made.keyword_search("amber", 5).count() == 2
    scored = made.similarity_search_with_relevance_scores("amber beads", 4).collect()
    assert all(0 <= r["relevance"] <= 1 for r in scored)
    assert made.max_marginal_relevance_search("amber", 2).count() == 2
    assert made.context("amber lantern", 1).first()["context"] == "amber lantern"
    made.build_index(n_lists=2, nprobe=2)
    assert made.similarity_search("winter", 4).count() == 4
    ids = made.add_texts(["copper whistle"]) + made.add_texts(["amber ring"], ids=["k2"])
    assert len(ids[0]) == 36 and ids[1] == "k2"
    assert [r["id"] for r in made.similarity_search("copper whistle", 1, nprobe=1).collect()] == ids[:1]
    assert [r["content"] for r in made.get_by_ids(["k2", "zz", ids[0]]).collect()] == [
        "amber ring", "copper whistle"]
    assert made.delete([]) is False and made.delete(filter={}) is False
    assert made.delete(["k3"]) is True and made.delete(filter={"theme": "light"}) is True
    left = {"k2", "k4", ids[0]}
    assert {r["id"] for r in made.rows().collect()} == left
    made.compact()
    assert {r["id"] for r in made.rows().collect()} == left
    assert not (tmp_path / "c" / made.folder().rsplit("/", 1)[1] / "erased").exists()
    assert made.similarity_search([1.0] * 64, 2).count() == 2


def test_metadata_must_be_an_object(spark, tmp_path):
    made = Collection(spark, str(tmp_path / "c"), HashedWords())
    for bad in ("{'a': 1}", "[1]", 5, "x"):
        with pytest.raises(ValueError):
            made.add_texts(["t"], [bad])
    made.add_texts(["t", "u"], ['{"a": 1}', None], ids=["1", "2"])
    assert [r["id"] for r in made.similarity_search("t", 4, {"a": 1}).collect()] == ["1"]


def test_promoted_keys_reach_the_scan(spark, tmp_path):
    made = letters(spark, tmp_path / "c", promoted_keys={"theme": "theme", "n": "number"},
                   promoted_types={"n": "bigint"})
    hits = made.similarity_search("orchard", 4, {"theme": {"$in": ["farm"]}, "n": {"$lt": 3}})
    assert [r["id"] for r in hits.collect()] == ["k3"]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = made.similarity_search("x", 1, {"theme": "farm"})._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(theme,farm)" in plan
    made.add_texts(["plum orchard"], [{"theme": "fruit", "n": "many"}], ids=["k3"])
    assert [r["id"] for r in made.keyword_search("orchard", 4, {"theme": "fruit"}).collect()] == ["k3"]
    assert made.similarity_search("orchard", 4, {"n": {"$gte": 0}}).count() == 3
    assert made.delete(filter={"theme": "fruit"}) and made.rows().count() == 3


def test_the_fulltext_index_follows_every_change(spark, tmp_path):
    made = letters(spark, tmp_path / "c")
    assert {r["score"] for r in made.keyword_search("amber beads", 4).collect()} == {1.0, 2.0}
    for _ in range(2):
        made.ensure_fulltext_index()

    def agrees(*asked):
        for text in asked:
            found = made.keyword_search(text, 5)
            plain = keyword.keyword_search(made.rows(), made._asked(text), 5, scorer="tfidf")
            keys = [(r["id"], round(r["score"], 9)) for r in found.orderBy("rank").collect()]
            assert not keys or any("/postings/" in f for f in found.inputFiles())
            assert keys == [(r["id"], round(r["score"], 9)) for r in plain.orderBy("rank").collect()]
        return keys

    agrees("amber beads")
    made.add_texts(["beads of jet", "amber jet jet"], ids=["k2", "k9"])
    made.delete(["k1"])
    assert [i for i, _ in agrees("amber", "jet")] == ["k9", "k2"]
    made.build_index(n_lists=2)
    made.add_texts(["lantern jet"], ids=["k1"])
    agrees("lantern jet")
    made.compact()
    made.add_texts(["lantern lantern"], ids=["k3"])
    assert [i for i, _ in agrees("lantern")] == ["k3", "k1"]
    assert made.hybrid_search("lantern", 2).count() == 2
    assert made.rows().schema["embedding"].dataType.simpleString() == "array<float>"


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_remove", "_save", "_commit"])
def test_a_failed_upsert_is_not_seen_and_can_be_repeated(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "u")
    rows = spark.createDataFrame([(str(i), f"old {i}", "{}", [1.0, float(i)]) for i in range(6)], SCHEMA)
    storage.write_rows(rows.withColumn("lang", F.lit("en")), path)
    before = sorted(storage.read_rows(spark, path).select("id", "content", "lang").collect())
    batch = spark.createDataFrame([("2", "new 2", "{}", [0.0, 1.0]), ("9", "new 9", "{}", None)], SCHEMA)
    real = getattr(storage, step)

    def broken(*args, **options):
        if step != "_commit":
            real(*args, **options)
        raise Crash

    monkeypatch.setattr(storage, step, broken)
    with pytest.raises(Crash):
        storage.upsert_rows(spark, path, batch)
    monkeypatch.setattr(storage, step, real)
    assert sorted(storage.read_rows(spark, path).select("id", "content", "lang").collect()) == before
    for _ in range(2):
        storage.upsert_rows(spark, path, batch)
        got = {r["id"]: (r["content"], r["lang"]) for r in storage.read_rows(spark, path).collect()}
        # Columns that the batch lacks stay as they were.
        assert got == {**{i: (c, lang) for i, c, lang in before}, "2": ("new 2", "en"),
                       "9": ("new 9", None)}
    with pytest.raises(ValueError):
        storage.upsert_rows(spark, path, batch.withColumn("extra", F.lit(1)))


@pytest.mark.parametrize("step", ["write_index", "add_version"])
def test_a_failed_build_can_be_repeated(spark, tmp_path, monkeypatch, step):
    made = letters(spark, tmp_path / "b")
    real = getattr(storage, step)

    def broken(*args, **options):
        if step == "write_index":
            real(*args, **options)
        raise Crash

    monkeypatch.setattr(storage, step, broken)
    with pytest.raises(Crash):
        made.build_index(n_lists=2)
    monkeypatch.setattr(storage, step, real)
    assert storage.read_centroids(spark, made.folder()) is None
    made.build_index(n_lists=2)
    assert storage.read_centroids(spark, made.folder()).count() == 2 and made.rows().count() == 4


def test_a_change_writes_no_more_than_its_batch(spark, tmp_path):
    path = str(tmp_path / "w")
    rows = spark.range(20_000).select(
        F.col("id").cast("string"), F.lit("text").alias("content"), F.lit("{}").alias("metadata"),
        F.array(F.rand(1), F.rand(2)).alias("embedding"))
    storage.write_rows(rows, path)

    def size():
        return sum(f.stat().st_size for f in (tmp_path / "w").rglob("*.parquet"))

    full = size()
    storage.upsert_rows(spark, path, rows.filter("id in (7, 8)"))
    storage.delete_rows(spark, path, rows.filter("id = 9"))
    assert size() - full < full / 20
    assert storage.read_rows(spark, path).count() == 19_999


def test_metric_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        Collection(spark, str(tmp_path), metric="nope")
