"""Maximal marginal relevance: close to the query, unlike each other."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.functions import kernels
from findry.functions.embed import Embedder
from findry.operators import ivf, topk
from findry.operators.search import embed_queries, find_nearest
from findry.schema import check_count


def _picks(wanted, vectors, k: int, balance: float):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def pick(queries: pa.Array, candidates: pa.Array) -> pa.Array:
        wanted = kernels.to_matrix(queries)
        sizes = pc.list_value_length(candidates).to_numpy()
        rows = kernels.to_matrix(candidates.flatten(), wanted.shape[1])
        stops = np.cumsum(sizes)
        at, out = 0, []
        while at < len(sizes):
            # Queries whose candidates fill one tensor of bounded size; one query at least.
            most = np.maximum.accumulate(sizes[at:]) * np.arange(1, len(sizes) - at + 1) * wanted.shape[1]
            end = at + max(1, int(np.searchsorted(most, kernels.PAIRS_AT_ONCE)))
            here = sizes[at:end]
            tensor = np.zeros((len(here), int(here.max()), wanted.shape[1]))
            first = stops[at] - sizes[at]
            owner = np.repeat(np.arange(len(here)), here)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(here) - here, here)
            tensor[owner, place] = rows[first:stops[end - 1]]
            out += kernels.diverse(wanted[at:end], tensor, here, k, balance)
            at = end
        return pa.array(out, pa.list_(pa.int32()))

    return pick(wanted, vectors)


def mmr(corpus: DataFrame, queries: DataFrame, k: int = 4, fetch_k: int = 20,
        lambda_mult: float = 0.5, metric: str = "cosine", filter: Mapping | None = None,
        centroids: DataFrame | None = None, nprobe: int | None = None,
        columns=(), *, default_nprobe: int = ivf.DEFAULT_NPROBE,
        promoted_keys: Mapping[str, str] | None = None) -> DataFrame:
    """Pick ``k`` of the ``fetch_k`` nearest rows of each query, trading closeness to the
    query (``lambda_mult``) against likeness to rows already picked.

    ``metric`` chooses the candidates; the trade-off is always by cosine.  ``rank`` is the
    order of picking, ``near_rank`` and ``distance`` those of the plain search.
    """
    check_count("k", k)
    check_count("fetch_k", fetch_k)
    near, most = find_nearest(corpus, queries, fetch_k, metric, filter, centroids, nprobe,
                              default_nprobe, promoted_keys)
    near = topk.look_up(near, corpus, ["embedding"], most)
    # At most fetch_k rows a group.
    grouped = near.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "rank", "id", "distance", F.col("embedding").cast("array<double>").alias("vector"))))
        .alias("near"))
    wanted = queries.select("query_id", F.col("embedding").cast("array<double>").alias("wanted"))
    picked = grouped.join(wanted, "query_id").select(
        "query_id", "near",
        F.posexplode(_picks(F.col("wanted"), F.col("near.vector"), k, lambda_mult)))
    chosen = F.col("near")[F.col("col")]
    result = picked.select(
        "query_id", chosen["id"].alias("id"), chosen["distance"].alias("distance"),
        chosen["rank"].alias("near_rank"), (F.col("pos") + 1).alias("rank"))
    return topk.look_up(result, corpus, list(columns), most) if columns else result


def mmr_text(corpus: DataFrame, queries: DataFrame, embedder: Embedder, **options) -> DataFrame:
    """:func:`mmr` for ``(query_id, text)`` queries."""
    return mmr(corpus, embed_queries(queries, embedder), **options)
