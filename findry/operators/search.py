"""Nearest-neighbour search: exact, filtered, and over the lists of an index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.functions import distance as dist
from findry.functions import filters
from findry.functions.embed import Embedder, embed
from findry.operators import ivf, topk
from findry.schema import check_count, check_metric
from findry.sources.lineage import cut_lineage


def find_nearest(corpus: DataFrame, queries: DataFrame, k: int, metric: str,
                 filter: Mapping | None = None, centroids: DataFrame | None = None,
                 nprobe: int | None = None, default_nprobe: int = ivf.DEFAULT_NPROBE,
                 promoted_keys: Mapping[str, str] | None = None) -> tuple[DataFrame, int]:
    """Ranked ``(query_id, id, distance, rank)`` rows and the most there can be."""
    check_count("k", k)
    check_metric(metric)
    rows = filters.keep(corpus, filter, promoted_keys=promoted_keys)
    wanted = queries.select("query_id", "embedding")
    if centroids is None:
        return topk.nearest_rows(rows.select("id", "embedding"), wanted, k, metric)
    wanted = ivf.probe(wanted, centroids, nprobe, default_nprobe)
    return topk.nearest_rows(rows.select("id", "embedding", "cluster"), wanted, k, metric)


def knn_join(corpus: DataFrame, queries: DataFrame, k: int = 4, metric: str = "cosine",
             filter: Mapping | None = None, centroids: DataFrame | None = None,
             nprobe: int | None = None, columns: Sequence[str] = (), *,
             default_nprobe: int = ivf.DEFAULT_NPROBE,
             promoted_keys: Mapping[str, str] | None = None) -> DataFrame:
    """The ``k`` nearest corpus rows of every query, closest first.

    ``queries`` is ``(query_id, embedding)``.  The filter applies before the choice of
    the nearest.  With ``centroids`` only the ``nprobe`` nearest lists of each query are
    scanned and the corpus must carry ``cluster``.  ``columns`` names corpus columns to
    add to the result, such as ``content``, ``metadata`` or ``embedding``.
    """
    found, most = find_nearest(corpus, queries, k, metric, filter, centroids, nprobe,
                               default_nprobe, promoted_keys)
    found = found.withColumn("score", dist.score(F.col("distance"))).select(
        "query_id", "id", "distance", "score", "rank")
    return topk.look_up(found, corpus, list(columns), most) if columns else found


def knn_single(corpus: DataFrame, vector: Sequence[float], k: int = 4, metric: str = "cosine",
               filter: Mapping | None = None, columns: Sequence[str] = (), *,
               promoted_keys: Mapping[str, str] | None = None) -> DataFrame:
    """The ``k`` corpus rows nearest to one vector, closest first."""
    check_count("k", k)
    check_metric(metric)
    rows = filters.keep(corpus, filter, promoted_keys=promoted_keys)
    found = topk.nearest_to(rows.select("id", "embedding"), vector, k, metric)
    found = found.withColumn("score", dist.score(F.col("distance")))
    if columns:
        found = topk.look_up(found, corpus, list(columns), k).orderBy("distance", "id")
    return found


def embed_queries(queries: DataFrame, embedder: Embedder) -> DataFrame:
    """Add ``embedding`` to ``(query_id, text)`` queries, each embedded once.

    A search looks at its queries more than once, so many of them are written to a table first.
    """
    embedded = queries.withColumn("embedding", embed(F.col("text"), embedder))
    few = queries.select("query_id").limit(topk.FIRST_LOOK_ROWS + 1).count() <= topk.FIRST_LOOK_ROWS
    return embedded if few else cut_lineage(embedded)


def search_text(corpus: DataFrame, queries: DataFrame, embedder: Embedder, k: int = 4,
                metric: str = "cosine", **options) -> DataFrame:
    """:func:`knn_join` for ``(query_id, text)`` queries."""
    return knn_join(corpus, embed_queries(queries, embedder), k, metric, **options)


def with_relevance(results: DataFrame, metric: str = "cosine") -> DataFrame:
    """Add ``relevance`` in [0, 1] to scored results."""
    return results.withColumn("relevance", dist.relevance(metric, F.col("score")))
