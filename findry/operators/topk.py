"""The k best rows of a large table for every query, in one distributed job.

Three plans give the same rows; which one runs depends on measured sizes.

* **Queries travel.**  The queries fit a broadcast.  The table is scanned once, in
  place; each task keeps ``k`` rows per query and only those are shuffled.
* **Table travels.**  The scanned table fits a broadcast (a set of centroids, a small
  corpus) and the queries do not.  Queries are answered where they lie.
* **Files travel.**  Neither fits.  The queries are written as files of bounded size.  The table
  is scanned once, in place; each task streams the files over a bounded part of its rows and
  passes on ``k`` rows per query and part (see :mod:`findry.sources.chunks`).

The merge of partial results runs in two steps so that no task sees one row from
every task of the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.functions import kernels
from findry.sources.chunks import cut_into_chunks

# Most bytes of one side that may be broadcast, and rows fetched before measuring.
BROADCAST_BYTES = 64 << 20
FIRST_LOOK_ROWS = 4096
# Size of the rows a task holds while it reads files of queries, and of such a file.
BLOCK_BYTES = 64 << 20
# Result rows that may be broadcast to look up their documents.
BROADCAST_ROWS = 500_000


@dataclass
class Side:
    """One side of a search: its rows, and all of them in memory if they are few."""

    frame: DataFrame
    local: pa.Table | None
    rows: int | None = None
    dim: int | None = None


def measure(frame: DataFrame, width: str, budget: int = BROADCAST_BYTES, per_row: int = 32,
            even: bool = True) -> Side:
    """Fetch a side if it is within ``budget`` bytes, else only count it.

    ``width`` names the array column whose elements take eight bytes each; ``per_row``
    adds what else a row costs.  Arrays of one length (``even``) are measured on the
    first rows, so that counting a large table does not read its vectors, unless those are all
    null.  Rows that can't be searched (see :func:`kernels.sound`) are left out of what is fetched.
    """
    first = frame.limit(FIRST_LOOK_ROWS + 1).toArrow()
    dim = pc.max(pc.list_value_length(first.column(width))).as_py() or 0
    n = first.num_rows
    if n > FIRST_LOOK_ROWS:
        if even and dim:
            n = frame.count()
        else:
            n, dim = frame.agg(F.count("*"), F.coalesce(F.max(F.size(width)), F.lit(0))).first()
    if n * (8 * dim + per_row) > budget:
        return Side(frame, None, n, dim)
    local = first if n <= FIRST_LOOK_ROWS else frame.toArrow()
    return Side(frame, local.filter(pa.array(kernels.sound(local.column(width)))), n, dim)


def broadcast_if_small(frame: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a narrow side counted to be small; else leave Spark to shuffle."""
    return F.broadcast(frame) if frame.count() <= most_rows else frame


def best_per_query(partials: DataFrame, k: int) -> DataFrame:
    """Merge ``(query_id, id, distance, part)`` rows; ranks by distance, then id."""
    fan = int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("distance"), F.col("id")]
    some = Window.partitionBy("query_id", F.pmod("part", F.lit(fan))).orderBy(*order)
    every = Window.partitionBy("query_id").orderBy(*order)
    return (
        partials.withColumn("part_rank", F.row_number().over(some))
        .filter(F.col("part_rank") <= k)
        .withColumn("rank", F.row_number().over(every))
        .filter(F.col("rank") <= k)
        .select("query_id", "id", "distance", "rank")
    )


def partial_schema(query_type: T.DataType, id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", query_type),
        T.StructField("id", id_type),
        T.StructField("distance", T.DoubleType()),
        T.StructField("part", T.IntegerType()),
    ])


def partial_batch(best: kernels.BestRows, query_ids: pa.Array, part: int):
    query, ids, distance = best.result()
    if ids is None:
        return None
    return pa.record_batch({
        "query_id": query_ids.take(pa.array(query)),
        "id": ids,
        "distance": pa.array(distance),
        "part": pa.array(np.full(len(query), part, np.int32)),
    })


def scan_with(table: DataFrame, needed: str, shared: dict, start: Callable,
              query_type: T.DataType) -> DataFrame:
    """Scan ``table`` in place, keeping each task's best rows that have ``needed``.

    ``start(shared)`` returns the keeper and its ``add(keeper, batch)`` step.
    """
    cast = table.sparkSession.sparkContext.broadcast(shared)

    def held(batch):
        # Dropped here and not by a filter, which would compute a computed column twice.
        return batch.filter(pa.array(kernels.sound(batch.column(needed))))

    def run(batches):
        values = cast.value
        best, add = start(values)
        for batch in batches:
            batch = held(batch)
            if batch.num_rows:
                add(best, batch)
        out = partial_batch(best, values["query_ids"], TaskContext.get().partitionId())
        if out is not None:
            yield out

    return table.mapInArrow(run, partial_schema(query_type, table.schema["id"].dataType))


def nearest_rows(corpus: DataFrame, queries: DataFrame, k: int, metric: str,
                 budget: int = BROADCAST_BYTES,
                 block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``(query_id, id, distance, rank)`` of the ``k`` nearest corpus rows per query,
    and the most rows that can be.

    ``corpus`` is ``(id, embedding)`` and ``queries`` ``(query_id, embedding)``.  With a
    ``cluster`` column in the corpus and ``clusters`` (a list) in the queries, a query
    only sees the rows of its clusters.
    """
    probed = "cluster" in corpus.columns
    side = measure(queries, "embedding", budget, per_row=32 + 24 * k)
    if side.local is not None:
        partials = _queries_travel(corpus, side, k, metric, probed)
    else:
        rows = measure(corpus, "embedding", budget)
        if rows.local is not None:
            partials = _table_travels(rows, queries, k, metric, probed)
        else:
            partials = _in_place(corpus, side, queries, k, metric, probed, block_bytes)
    return best_per_query(partials, k), side.rows * k


def nearest_to(corpus: DataFrame, vector: Sequence[float], k: int, metric: str) -> DataFrame:
    """``(id, distance)`` of the ``k`` corpus rows nearest to one vector, closest first."""
    one = corpus.sparkSession.createDataFrame([], "query_id int, embedding array<double>")
    local = pa.table({"query_id": pa.array([0], pa.int32()),
                      "embedding": pa.array([[float(x) for x in vector]], pa.list_(pa.float64()))})
    partials = _queries_travel(corpus, Side(one, local, 1, len(vector)), k, metric, False)
    return best_per_query(partials, k).select("id", "distance").orderBy("distance", "id").limit(k)


def searchable(vector="embedding"):
    """Column: the vector is not null and all its elements are finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
                      F.lit(False))


def look_up(results: DataFrame, corpus: DataFrame, columns: list[str], most_rows: int) -> DataFrame:
    """Add columns of the found rows.

    The wide columns stay out of the search and are read here for its results only; a
    result table of bounded size is sent to the corpus rather than shuffling the corpus.
    """
    wide = corpus.select("id", *columns)
    if most_rows <= BROADCAST_ROWS:
        results = F.broadcast(results)
    kept = [c for c in results.columns if c not in columns]
    return wide.join(results.select(*kept), "id").select(*kept, *columns)


def _members(clusters) -> dict[int, np.ndarray]:
    """Cluster -> indexes of the queries that list it."""
    lists = kernels.one_array(clusters)
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    flat = lists.flatten().to_numpy()
    return {int(c): owner[flat == c] for c in np.unique(flat)}


def _queries_travel(corpus, side: Side, k, metric, probed) -> DataFrame:
    shared = {"query_ids": kernels.one_array(side.local.column("query_id")),
              "matrix": kernels.to_matrix(side.local.column("embedding"))}
    if probed:
        shared["members"] = _members(side.local.column("clusters"))
        # Literal list numbers prune the partitions of an index written by cluster.
        corpus = corpus.filter(F.col("cluster").isin(sorted(shared["members"])))

    def start(values):
        return kernels.NearestVectors(values["matrix"], k, metric, values.get("members")), add

    def add(best, batch):
        rows = kernels.to_matrix(batch.column("embedding"), best.queries.shape[1])
        best.add(rows, batch.column("id"),
                 batch.column("cluster").to_numpy() if probed else None)

    query_type = side.frame.schema["query_id"].dataType
    columns = ["id", "embedding"] + (["cluster"] if probed else [])
    if not side.local.num_rows:
        corpus = corpus.limit(0)
    return scan_with(corpus.select(*columns), "embedding", shared, start, query_type)


def _table_travels(rows: Side, queries, k, metric, probed) -> DataFrame:
    shared = {"ids": kernels.one_array(rows.local.column("id")),
              "matrix": kernels.to_matrix(rows.local.column("embedding"), rows.dim)}
    if probed:
        shared["clusters"] = pc.fill_null(rows.local.column("cluster"), -1).to_numpy()
    cast = queries.sparkSession.sparkContext.broadcast(shared)

    def run(batches):
        values = cast.value
        part = TaskContext.get().partitionId()
        for batch in batches:
            batch = batch.filter(pa.array(kernels.sound(batch.column("embedding"))))
            if not batch.num_rows or not len(values["matrix"]):
                continue
            best = kernels.NearestVectors(
                kernels.to_matrix(batch.column("embedding"), values["matrix"].shape[1]), k, metric,
                _members(batch.column("clusters")) if probed else None)
            best.add(values["matrix"], values["ids"], values.get("clusters"))
            out = partial_batch(best, batch.column("query_id"), part)
            if out is not None:
                yield out

    schema = partial_schema(queries.schema["query_id"].dataType, rows.frame.schema["id"].dataType)
    return queries.mapInArrow(run, schema)


def _in_place(corpus: DataFrame, side: Side, queries: DataFrame, k, metric, probed, block_bytes) -> DataFrame:
    """The queries are written as files which the tasks of the scan read; the corpus is not moved.

    A query that probes several lists stands in the files once for each, so that a task opens the files of
    its own lists only.
    """
    per_chunk = max(1, block_bytes // (8 * max(1, side.dim) + 32))
    queries = queries.filter(searchable())
    rows = side.rows
    if probed:
        queries = queries.select("query_id", "embedding", F.explode("clusters").alias("cluster"))
        rows = queries.count()
        # One row for each list.
        lists = queries.select("cluster").distinct()
        corpus = corpus.join(broadcast_if_small(lists), "cluster", "left_semi")
    written = cut_into_chunks(queries, rows, per_chunk, *(["cluster", "query_id"] if probed else []))

    def start(held):
        part = TaskContext.get().partitionId()
        matrix, ids = kernels.to_matrix(held.column("embedding")), kernels.one_array(held.column("id"))
        groups = held.column("cluster").to_numpy() if probed else None

        def score(chunk):
            members = None
            if probed:
                asked = chunk.column("cluster").to_numpy()
                members = {int(c): np.flatnonzero(asked == c) for c in np.unique(asked)}
            best = kernels.NearestVectors(
                kernels.to_matrix(chunk.column("embedding"), matrix.shape[1]), k, metric, members)
            best.add(matrix, ids, groups)
            return partial_batch(best, kernels.one_array(chunk.column("query_id")), part)

        return score

    columns = ["id", "embedding"] + (["cluster"] if probed else [])
    schema = partial_schema(queries.schema["query_id"].dataType, corpus.schema["id"].dataType)
    return written.scan(corpus.select(*columns), "embedding", start, schema, block_bytes)
