"""What a look-up of documents by id moves."""

from pyspark.sql import functions as F

from findry.operators import corpus as ops
from findry.plans.queries import QUERIES


def test_texts_stay_out_of_the_shuffles_of_a_look_up(spark, tmp_path):
    spark.createDataFrame([(9 * i, "x" * i, "en", "src1", i) for i in range(20)],
                          "doc_id long, text string, lang string, source string, n_chars int"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 25) for i in range(60)] + [(99, None)], "event_id long, user_id long"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["get_by_ids"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "content" not in above.replace("n_content", "") and "text" not in above
    assert [tuple(r) for r in found.collect()] == [(i, 9 * (i % 25), i % 25) for i in range(60) if i % 25 < 20]
    docs = spark.createDataFrame([("a", "one", "{}")], "id string, content string, metadata string")
    asked = ops.request(spark, ["a", "b", "a"])
    whole = ops.get_by_ids(docs, asked)
    assert whole.columns == ["position", "id", "content", "metadata"] and whole.count() == 2
    assert ops.get_by_ids(docs.withColumn("n", F.length("content")), asked, ["n"]).columns == ["position", "id", "n"]
