"""Fusing vector and keyword results by rank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from findry.functions.embed import Embedder
from findry.operators import ivf, topk
from findry.operators.keyword import find_keywords
from findry.operators.search import embed_queries, find_nearest
from findry.schema import check_count


def check_weight(weight: float) -> float:
    if not 0.0 <= weight <= 1.0:
        raise ValueError(f"vector_weight must be between 0 and 1, got {weight!r}")
    return float(weight)


def rrf_fuse(vector: DataFrame, keyword: DataFrame, k: int = 4, vector_weight: float = 0.5,
             rrf_k: int = 60) -> DataFrame:
    """Weighted reciprocal-rank fusion of two ranked ``(query_id, id, rank)`` tables.

    A row of either list takes part, also when its weight makes its score zero.  Equal
    scores go by rank in the vector list, then in the keyword list, then by id.
    """
    check_count("k", k)
    weight = check_weight(vector_weight)
    none = F.lit(None).cast("int")
    both = (
        vector.select("query_id", "id", F.col("rank").alias("v"), none.alias("w"))
        .unionByName(keyword.select("query_id", "id", none.alias("v"), F.col("rank").alias("w")))
        .groupBy("query_id", "id")
        .agg(F.min("v").alias("vector_rank"), F.min("w").alias("keyword_rank")))
    score = (F.coalesce(F.lit(weight) / (F.col("vector_rank") + rrf_k), F.lit(0.0))
             + F.coalesce(F.lit(1.0 - weight) / (F.col("keyword_rank") + rrf_k), F.lit(0.0)))
    best = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("vector_rank").asc_nulls_last(),
        F.col("keyword_rank").asc_nulls_last(), "id")
    return (both.withColumn("score", score)
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "id", "score", "rank"))


def hybrid_search(corpus: DataFrame, queries: DataFrame, embedder: Embedder | None = None,
                  k: int = 4, fetch_k: int = 20, filter: Mapping | None = None,
                  vector_weight: float = 0.5, rrf_k: int = 60, metric: str = "cosine",
                  scorer: str = "overlap", centroids: DataFrame | None = None,
                  nprobe: int | None = None, index: DataFrame | None = None, columns=(), *,
                  default_nprobe: int = ivf.DEFAULT_NPROBE,
                  promoted_keys: Mapping[str, str] | None = None) -> DataFrame:
    """Fuse the ``fetch_k`` nearest and the ``fetch_k`` best keyword matches of each query.

    ``queries`` is ``(query_id, text)``, with ``embedding`` too if no ``embedder`` is given.
    Both sides honour the filter; the keyword side is never limited to probed lists.
    """
    check_weight(vector_weight)
    check_count("fetch_k", fetch_k)
    if embedder is not None:
        queries = embed_queries(queries, embedder)
    near, most_near = find_nearest(corpus, queries, fetch_k, metric, filter, centroids, nprobe,
                                   default_nprobe, promoted_keys)
    match, most_match = find_keywords(corpus, queries, fetch_k, filter, scorer, index,
                                      promoted_keys=promoted_keys)
    fused = rrf_fuse(near, match, k, vector_weight, rrf_k)
    if not columns:
        return fused
    return topk.look_up(fused, corpus, list(columns), most_near + most_match)
