"""What the plans of the registered queries must and must not contain."""

import pytest

import __spark_entry__ as entry
from findry.plans.oracles import ORACLES
from findry.plans.queries import QUERIES
from findry.sources.storage import spread

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in text
    # Only a limit over a handful of rows may gather in one task.
    if name not in ("knn_single", "recall_at_k", "ivf_scan_fraction"):
        assert "SinglePartition" not in text


def test_every_query_but_training_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"ivf_centroids"}
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_a_search_reads_only_ids_and_vectors_and_embeds_once(spark):
    text = plan(entry.queries()["knn_join"](spark, FOLDER))
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text
    text = plan(entry.queries()["search_text"](spark, FOLDER))
    assert text.count("ArrowEvalPython") == 1 and text.count("WindowGroupLimit") == 4
    text = plan(entry.queries()["ivf_search"](spark, FOLDER))
    assert text.count("ArrowEvalPython") == 1


def test_upserts_are_limited_before_the_shuffle(spark):
    text = plan(entry.queries()["upsert"](spark, FOLDER))
    assert text.count("WindowGroupLimit") == 2 and "LeftAnti, BuildRight" in text


def test_spread(spark):
    one = spark.read.parquet(f"{FOLDER}/documents.parquet").coalesce(1)
    assert spread(one, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=9)
    assert spread(many, "id").rdd.getNumPartitions() == 9


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["query_id", "id", "score", "rank"] and result.count() > 0
