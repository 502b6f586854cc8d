"""The operators of this folder as queries over whole tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm import (additive, alignment, bpe, graphdedup, langid, negatives, packing, rules, shards, simhash,
                        spans, surrogates, toxicity)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_rules(spark, folder):
    found = rules.apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


@query
def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = langid.train(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred",
                        "score", "rejected")


@query
def op3_substring_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spans.clean(docs).select("doc_id", "text", "n_removed", "removed")


@query
def op4_simhash_near_dedup(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query
def op5_quality_classifier(spark, folder):
    return additive.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_pii_surrogates(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs).select(
        "doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


@query
def op7_bpe_round_trip(spark, folder):
    coded = bpe.round_trip(table(spark, folder, "documents"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op8_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query
def op9_embedding_near_dedup(spark, folder):
    found, recall = graphdedup.near_duplicates(table(spark, folder, "embeddings"))
    return found.withColumn("audited_recall", F.lit(recall))


@query
def op10_training_order_shards(spark, folder):
    written = shards.materialise(table(spark, folder, "documents"))
    return written.read().select("slot", "shard", "row", "doc_id", "start", "n_tokens",
                                 F.crc32("ids").alias("ids_crc32"), "valid")


@query
def op11_cross_tokenizer_alignment(spark, folder):
    found = alignment.summarise(table(spark, folder, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_hard_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")


# Vectors hold the same numbers in 64-bit integers; lists are no longer than a table's vectors.
ORACLES["op12_hard_negatives"] = """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256e0 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM rows_ WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM anchors a, rows_ r WHERE r.vec_id <> a.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10"""


@query
def op13_toxicity(spark, folder):
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
