"""Where rows lie and which places are gone: removals, rows that come back, order across batches, plans."""

import pytest
from pyspark.sql import functions as F

from findry.operators import topk
from findry.sources import directory, storage

SCHEMA = "id string, content string, metadata string, embedding array<double>"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def numbered(spark, n, text="old", first=0):
    return spark.range(first, first + n).select(
        F.col("id").cast("string"), F.concat(F.lit(text + " "), F.col("id").cast("string")).alias("content"),
        F.lit("{}").alias("metadata"), F.array().cast("array<double>").alias("embedding"))


def contents(spark, path):
    return {r["id"]: r["content"] for r in storage.read_rows(spark, path).select("id", "content").collect()}


@pytest.mark.parametrize("words", [directory.WORDS, 40])
def test_removals_returns_and_a_stale_change(spark, tmp_path, monkeypatch, words):
    monkeypatch.setattr(directory, "WORDS", words)
    monkeypatch.setattr(directory, "IDS_PER_BUCKET", 500)
    path = str(tmp_path / "c")
    storage.write_rows(numbered(spark, 6000), path, rows_per_file=700)
    want = {str(i): f"old {i}" for i in range(6000)}
    storage.delete_rows(spark, path, spark.range(0, 6000, 2).select(F.col("id").cast("string")))
    want = {i: c for i, c in want.items() if int(i) % 2}
    storage.upsert_rows(spark, path, numbered(spark, 900, "new", 100))
    want.update({str(i): f"new {i}" for i in range(100, 1000)})
    storage.delete_rows(spark, path, numbered(spark, 300, "", 800))
    want = {i: c for i, c in want.items() if not 800 <= int(i) < 1100}
    storage.upsert_rows(spark, path, numbered(spark, 10, "back", 900))
    want.update({str(i): f"back {i}" for i in range(900, 910)})
    # A writer that failed before its commit leaves places behind that do not count.
    old = directory.locate(spark, path, numbered(spark, 500, "", 1200).select("id"),
                           storage.changes_of(spark, path), storage.read_rows(spark, path).schema["id"].dataType)
    directory.erase(old, path, "cstale")
    assert contents(spark, path) == want
    rows = storage.read_rows(spark, path)
    assert "Exchange hashpartitioning(id" not in plan(rows)
    if words == 40:
        assert plan(rows).count("FileScan parquet") > 4  # groups of files, each with its own words
    some = [str(i) for i in (1, 2, 101, 850, 905, 5999)] + ["none"]
    asked = spark.createDataFrame([(i,) for i in some], "id string")
    found = {r["id"]: r["content"] for r in storage.read_rows(spark, path, asked).collect()}
    assert found == {i: want[i] for i in some if i in want}
    storage.compact(spark, path, str(tmp_path / "d"))
    assert contents(spark, str(tmp_path / "d")) == want


def test_a_million_removals_move_no_row(spark, tmp_path):
    path = str(tmp_path / "m")
    storage.write_rows(numbered(spark, 1_200_000), path)
    gone = spark.range(1_200_000).where("id % 6 > 0").select(F.col("id").cast("string"))
    storage.delete_rows(spark, path, gone)
    rows = storage.read_rows(spark, path)
    text = plan(rows)
    # The only shuffle is that of the bitmap words, before they are sent.
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == text.count("Exchange hash") == 1
    assert rows.agg(F.count("*"), F.sum(F.col("id").cast("long"))).first() == (
        200_000, sum(range(0, 1_200_000, 6)))


def test_finding_ids_reads_their_buckets_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(directory, "IDS_PER_BUCKET", 100)
    path = str(tmp_path / "b")
    storage.write_rows(numbered(spark, 6400), path, rows_per_file=500)
    changes = storage.changes_of(spark, path)
    kind = storage.read_rows(spark, path).schema["id"].dataType
    for n in (1, 3, 2000):
        found = directory.locate(spark, path, numbered(spark, n, "", 50).select("id"), changes, kind)
        assert found.count() == n
        wanted = numbered(spark, n, "", 50).select("id")
        buckets = wanted.select(directory._bucket(64)).distinct().count()
        assert "PartitionFilters" in plan(found)
        assert buckets <= n and found.select(directory.FILE, directory.AT).distinct().count() == n
    assert len(list((tmp_path / "b" / "ids").glob("bucket=*"))) == 64
    one = spark.createDataFrame([("55",)], "id string")
    files = [f for f in storage.read_rows(spark, path, one).inputFiles() if "/rows/" in f]
    assert len(files) == 1 < len(storage.read_rows(spark, path).inputFiles())


def test_the_latest_row_wins_in_whichever_batch_it_comes(spark, tmp_path):
    path = str(tmp_path / "o")

    def batch(rows):
        return spark.createDataFrame([(i, c, "{}", None, at) for i, c, at in rows], SCHEMA + ", at long")

    storage.upsert_rows(spark, path, batch([("a", "a5", 5), ("b", "b1", 1), ("n", "none", None)]), "at")
    storage.upsert_rows(spark, path, batch([("a", "a3", 3), ("b", "b2", 2), ("c", "c9", 9), ("n", "n1", 1)]), "at")
    storage.upsert_rows(spark, path, batch([("c", "c7", 7), ("c", "c8", 8), ("n", "later none", None)]), "at")
    assert contents(spark, path) == {"a": "a5", "b": "b2", "c": "c9", "n": "n1"}
    storage.delete_rows(spark, path, spark.createDataFrame([("b",)], "id string"))
    storage.upsert_rows(spark, path, batch([("b", "b1", 1)]), "at")  # older than what was deleted
    storage.upsert_rows(spark, path, batch([("c", "c9 again", 9)]), "at")
    assert contents(spark, path) == {"a": "a5", "c": "c9 again", "n": "n1"}
    with pytest.raises(ValueError):
        storage.upsert_rows(spark, path, batch([("a", "x", 1)]).withColumn("at", F.lit("x")), "at")


def test_an_empty_folder_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "e")
    storage.write_rows(numbered(spark, 0), path)
    assert storage.read_rows(spark, path) is None
    storage.upsert_rows(spark, path, spark.createDataFrame(
        [("a", "x", "{}", None), (None, "y", "{}", None)], SCHEMA))
    storage.delete_rows(spark, path, spark.createDataFrame([("a",), (None,)], "id string"))
    assert [r["content"] for r in storage.read_rows(spark, path).collect()] == ["y"]


def test_no_row_of_the_corpus_is_shuffled_by_a_search_of_many_queries(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "embedding")
    asked = rows.withColumnRenamed("id", "query_id")
    found, _ = topk.nearest_rows(rows, asked, 3, "dot", budget=0, block_bytes=20_000)
    text = plan(found)
    below = text[text.index("MapInArrow"):]
    assert "Exchange" not in below.split("== ")[0].split("FileScan")[0] and text.count("FileScan") == 1
    assert found.count() == 3 * rows.count()
