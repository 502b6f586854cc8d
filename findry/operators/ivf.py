"""Inverted-file index: k-means lists, and searches that scan only the nearest ones.

Lists are formed by squared Euclidean distance whatever metric ranks the rows, so
normalise vectors first if they are ranked by dot product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.functions import kernels
from findry.operators import topk
from findry.schema import check_count
from findry.sources.lineage import cut_lineage, fixed

DEFAULT_NPROBE = 8
# Training rows by default: in all at least, and for each list.
SAMPLE = 50_000
ROWS_PER_LIST = 256
CENTROID_SCHEMA = "cid int, centroid array<double>"


@dataclass
class Index:
    """Centroids ``(cid, centroid)`` and the rows with their ``cluster``."""

    centroids: DataFrame
    rows: DataFrame
    nprobe: int = DEFAULT_NPROBE
    # (list, share of the rows) as estimated from the training sample, for file layout.
    shares: DataFrame | None = None


def _lists_udf(spark: SparkSession, cids: np.ndarray, matrix: np.ndarray, n: int):
    """Column function: vector -> its ``n`` nearest list numbers, nearest first."""
    cast = spark.sparkContext.broadcast((cids, matrix))
    take = min(n, len(cids))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest_lists(batch: pa.Array) -> pa.Array:
        numbers, centres = cast.value
        valid = kernels.sound(batch)
        rows = np.flatnonzero(valid)
        best = kernels.NearestVectors(
            kernels.to_matrix(batch.take(pa.array(rows)), centres.shape[1]), take, "sqeuclidean")
        best.add(centres, pa.array(numbers, pa.int32()))
        query, found, _ = best.result()
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows[query], minlength=len(valid)))])
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32(), mask=np.append(~valid, False)),
            found if found is not None else pa.array([], pa.int32()))

    # Keeps a condition on the list from being pushed below and computing it a second time.
    return nearest_lists.asNondeterministic()


def _local(centroids: DataFrame) -> tuple[topk.Side, tuple | None]:
    side = topk.measure(centroids.select("cid", "centroid"), "centroid")
    if side.rows == 0:
        raise ValueError("the index has no centroids")
    if side.local is None:
        return side, None
    return side, (side.local.column("cid").to_numpy().astype(np.int32),
                  kernels.to_matrix(side.local.column("centroid")))


def _with_lists(table: DataFrame, key: str, centroids: DataFrame, n: int) -> DataFrame:
    """Add ``clusters``: the ``n`` nearest lists of each row's embedding."""
    _, local = _local(centroids)
    if local is not None:
        return table.withColumn(
            "clusters", _lists_udf(table.sparkSession, *local, n)(F.col("embedding")))
    near, _ = topk.nearest_rows(
        centroids.select(F.col("cid").alias("id"), F.col("centroid").alias("embedding")),
        table.filter(topk.searchable())
        .select(F.col(key).alias("query_id"), "embedding"), n, "sqeuclidean")
    lists = near.groupBy(F.col("query_id").alias(key)).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda s: s["id"])
        .alias("clusters"))
    return table.join(lists, key, "left")


def assign(table: DataFrame, centroids: DataFrame) -> DataFrame:
    """Set every row's ``cluster`` to its nearest list (lowest number on a tie).

    A map over the rows: only the embedding column leaves the JVM.  Rows without an
    embedding get no cluster.
    """
    table = table.drop("cluster")
    lists = _with_lists(table, "id", centroids, 1)
    return lists.withColumn("cluster", F.col("clusters")[0]).drop("clusters")


def probe(queries: DataFrame, centroids: DataFrame, nprobe: int | None = None,
          default: int = DEFAULT_NPROBE) -> DataFrame:
    """Add ``clusters``, the lists to scan for each query.  None or 0 means the default."""
    n = default if not nprobe else check_count("nprobe", nprobe)
    return _with_lists(queries.drop("clusters"), "query_id", centroids, n)


def _list_means(assigned: DataFrame) -> DataFrame:
    """Mean vector of each list; partial means are formed before the shuffle."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return (assigned.groupBy(F.col("cluster").alias("cid")).agg(Summarizer.mean(vector).alias("mean"))
            .select("cid", vector_to_array("mean").alias("mean")))


def kmeans_step(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """One Lloyd step: move each centroid to the mean of its rows; an empty one stays."""
    means = _list_means(assign(vectors.filter(topk.searchable()), centroids))
    return centroids.join(means, "cid", "left").select(
        "cid", F.coalesce("mean", "centroid").alias("centroid"))


def kmeans(vectors: DataFrame, centroids: DataFrame, rounds: int) -> DataFrame:
    """Lloyd's algorithm from given centroids; every round is run."""
    side = topk.measure(centroids.orderBy("cid").select("cid", "centroid"), "centroid")
    if side.local is None:
        for _ in range(rounds):
            centroids = cut_lineage(kmeans_step(vectors, centroids))
        return centroids
    cids = side.local.column("cid").to_numpy().astype(np.int32)
    centres = kernels.to_matrix(side.local.column("centroid"))
    rows = vectors.filter(topk.searchable()).select("embedding")
    for _ in range(rounds):
        centres = _moved(rows, centres)
    return _centroid_frame(vectors.sparkSession, centres, cids)


def _seeded(id_column: str, seed: int):
    return F.xxhash64(F.col(id_column).cast("string"), F.lit(seed))


def training_sample(vectors: DataFrame, size: int, seed: int) -> DataFrame:
    """``size`` rows with a searchable vector, picked by a seeded hash of their id, or all of
    them if there are fewer.

    Only hashes are sorted.  A first cut keeps about a fifth more rows than needed, so the sort
    sees no more of the table than that.
    """
    whole = rows = vectors.filter(topk.searchable()).select(
        "id", "embedding", _seeded("id", seed).alias("draw"))
    total = rows.count()
    if total <= size:
        return whole
    share = min(1.0, (size * 1.2 + 100) / total)
    while True:
        limit = int(-(2 ** 63) + share * (2 ** 64 - 1))
        low = rows.filter(F.col("draw") <= min(limit, 2 ** 63 - 1))
        edge = (low.select("draw", "id").orderBy("draw", "id").limit(size)
                .agg(F.count("*").alias("n"), F.max(F.struct("draw", "id")).alias("last")).first())
        if edge["n"] == size:
            draw, last_id = edge["last"]
            return whole.filter((F.col("draw") < draw)
                                | ((F.col("draw") == draw) & (F.col("id") <= last_id)))
        share = min(1.0, share * 2)


def train(vectors: DataFrame, n_lists: int = 100, sample: int | None = None, iters: int = 10,
          seed: int = 0) -> DataFrame:
    """K-means centroids of a sample.  Only the centroids pass through the driver.

    The start is a seeded choice of rows; every one of ``iters`` rounds is run.  Without a
    ``sample`` size it grows with the lists.  A corpus with fewer vectors than lists gets one list
    a vector; a sample that is too small for the lists is refused.
    """
    return _train(vectors, n_lists, sample, iters, seed)[0]


def _train(vectors, n_lists, sample, iters, seed) -> tuple[DataFrame, DataFrame]:
    """Centroids, and the training rows of each list."""
    check_count("n_lists", n_lists)
    sample = max(SAMPLE, ROWS_PER_LIST * n_lists) if sample is None else check_count("sample", sample)
    check_count("iters", iters, 0)
    spark = vectors.sparkSession
    # The sample is gathered from every task of a large scan into partitions of its own size.
    with fixed(training_sample(vectors, sample, seed).repartition("id")) as chosen:
        rows = chosen.count()
        if not rows:
            raise ValueError("nothing to index: the corpus has no vectors")
        if rows == sample < n_lists:
            raise ValueError(f"{n_lists} lists need a sample of as many rows at least, got {sample}")
        k = min(n_lists, rows)
        starts = (chosen.select("id", "embedding", _seeded("id", seed + 1).alias("start"))
                  .orderBy("start", "id").limit(k).select("embedding").toArrow())
        centres = kernels.to_matrix(starts.column("embedding"))
        if k < rows:
            for _ in range(iters):
                centres = _moved(chosen, centres)
        centroids = _centroid_frame(spark, centres)
        # One row a list.
        shares = assign(chosen, centroids).groupBy("cluster").agg(
            (F.count("*") / rows).alias("share")).toArrow()
    return centroids, spark.createDataFrame(shares, "cluster int, share double")


def _moved(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """One Lloyd step on centroids held by the driver."""
    if centres.nbytes <= topk.BROADCAST_BYTES:
        lists = _lists_udf(vectors.sparkSession, np.arange(len(centres)), centres, 1)
        assigned = vectors.select("embedding", lists(F.col("embedding"))[0].alias("cluster"))
    else:
        assigned = assign(vectors, _centroid_frame(vectors.sparkSession, centres))
    means = _list_means(assigned).toArrow()
    centres = centres.copy()
    centres[means.column("cid").to_numpy()] = kernels.to_matrix(means.column("mean"))
    return centres


def _centroid_frame(spark: SparkSession, centres: np.ndarray, cids: np.ndarray | None = None) -> DataFrame:
    dim = centres.shape[1]
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(centres) + 1) * dim, pa.int32()), pa.array(centres.ravel()))
    return spark.createDataFrame(
        pa.table({"cid": pa.array(np.arange(len(centres)) if cids is None else cids, pa.int32()),
                  "centroid": lists}),
        CENTROID_SCHEMA)


def build_index(corpus: DataFrame, n_lists: int = 100, sample: int | None = None, iters: int = 10,
                nprobe: int = DEFAULT_NPROBE, seed: int = 0) -> Index:
    """Train centroids and assign every row.  Building again replaces the lists."""
    check_count("nprobe", nprobe)
    centroids, shares = _train(corpus.select("id", "embedding"), n_lists, sample, iters, seed)
    return Index(centroids, assign(corpus, centroids), nprobe, shares)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: how many of the exact results were found, of how many."""
    keys = ["query_id", "id"]
    both = exact.select(*keys).join(found.select(*keys).withColumn("hit", F.lit(1)), keys, "left")
    return both.agg(F.count("hit").alias("hits"), F.count("*").alias("total")).withColumn(
        "recall", F.col("hits") / F.col("total"))


def scan_fraction(rows: DataFrame, probes: DataFrame) -> DataFrame:
    """Share of the rows each query scans, from list sizes alone."""
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    per_query = (
        probes.select("query_id", F.explode("clusters").alias("cluster"))
        .join(sizes, "cluster", "left")
        .groupBy("query_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("scanned")))
    return per_query.withColumn("total", total.scalar()).withColumn(
        "fraction", F.col("scanned") / F.col("total"))


def recall_curve(index: Index, queries: DataFrame, k: int = 10, metric: str = "cosine",
                 most: int = 64) -> DataFrame:
    """``nprobe, recall``: the share of the exact ``k`` nearest rows found by probing so many lists.

    One exact search tells it for all numbers of probes up to ``most``: a row is found as soon as its list is.
    """
    from findry.operators.search import knn_join

    queries = queries.select("query_id", "embedding")
    exact = knn_join(index.rows, queries, k, metric, columns=["cluster"])
    order = (probe(queries, index.centroids, most)
             .select("query_id", F.posexplode("clusters").alias("place", "cluster")))
    found = exact.join(order, ["query_id", "cluster"], "left").groupBy("place").agg(F.count("*").alias("n"))
    # One row for each number of probes.
    places = found.collect()
    total, at = sum(r["n"] for r in places), 0
    by_place = {r["place"]: r["n"] for r in places}
    rows = []
    for nprobe in range(1, most + 1):
        at += by_place.get(nprobe - 1, 0)
        rows.append((nprobe, at / total if total else 1.0))
    return queries.sparkSession.createDataFrame(rows, "nprobe int, recall double")


def calibrate(index: Index, queries: DataFrame, target: float = 0.9, k: int = 10, metric: str = "cosine",
              most: int = 64) -> int | None:
    """The fewest probes whose recall over ``queries`` reaches ``target``; None if ``most`` do not."""
    enough = recall_curve(index, queries, k, metric, most).where(F.col("recall") >= target)
    return enough.agg(F.min("nprobe")).first()[0]
