"""Reading, validating and changing a corpus ``(id, content, metadata, embedding)``.

Every operator takes DataFrames and returns a new one; nothing is changed in place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.functions import filters
from findry.functions.embed import Embedder, embed
from findry.operators import topk
from findry.operators.topk import broadcast_if_small


def all_embeddings(corpus: DataFrame) -> DataFrame:
    return corpus.select("id", "embedding")


def _fits(dim: int):
    vector = F.col("embedding")
    return F.coalesce(
        (F.size(vector) == dim) & topk.searchable(vector), F.lit(False))


def validate_dim(corpus: DataFrame, dim: int) -> DataFrame:
    """Rows whose embedding has ``dim`` elements, all of them finite numbers."""
    return corpus.filter(_fits(dim))


def rejected_rows(corpus: DataFrame, dim: int) -> DataFrame:
    """The rows :func:`validate_dim` leaves out."""
    return corpus.filter(~_fits(dim))


def vector_from_json(text) -> F.Column:
    """Parse a JSON array of numbers; null if the text is none."""
    return F.from_json(text, "array<double>")


def vector_to_json(vector) -> F.Column:
    return F.to_json(vector.cast("array<double>"))


def with_defaults(rows: DataFrame, id_from: str = "uuid") -> DataFrame:
    """Fill in absent ids and metadata.

    ``id_from="content"`` derives ids from the text, so the same text gets the same id
    in every run; ``"uuid"`` draws random ones.
    """
    if id_from not in ("uuid", "content"):
        raise ValueError(f"id_from must be 'uuid' or 'content', got {id_from!r}")
    fresh = F.uuid() if id_from == "uuid" else F.sha2(F.col("content"), 256)
    for name in ("id", "metadata"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    others = [c for c in rows.columns if c not in ("id", "metadata")]
    return rows.select(F.coalesce("id", fresh).alias("id"),
                       F.coalesce("metadata", F.lit("{}")).alias("metadata"), *others)


def latest(batch: DataFrame, order_by: str | None = None) -> DataFrame:
    """One row per id, the last by ``order_by`` (by position in the batch if None).

    The limit is taken before the shuffle too, so an id repeated any number of times
    costs a reducer at most one row per task.
    """
    order = "__order"
    batch = batch.withColumn(
        order, F.monotonically_increasing_id() if order_by is None else F.col(order_by))
    last = Window.partitionBy("id").orderBy(F.col(order).desc())
    return (batch.withColumn("__place", F.row_number().over(last))
            .filter(F.col("__place") == 1).drop("__place", order))


def upsert(base: DataFrame, batch: DataFrame, order_by: str | None = None) -> DataFrame:
    """Insert rows, or replace those with the same id; the last row of an id wins.

    Columns of ``base`` that the batch lacks keep the replaced row's value.
    """
    new = latest(batch, order_by)
    new = new.select(*[c for c in base.columns if c in new.columns])
    ids = broadcast_if_small(batch.select("id").distinct())
    held = [c for c in base.columns if c not in new.columns]
    if held:
        old = base.select("id", *held).join(ids, "id", "left_semi")
        new = new.join(old, "id", "left")
    return base.join(ids, "id", "left_anti").unionByName(new.select(*base.columns))


def add_texts(base: DataFrame, rows: DataFrame, embedder: Embedder,
              centroids: DataFrame | None = None, order_by: str | None = None,
              id_from: str = "uuid") -> DataFrame:
    """Embed ``(content[, id, metadata])`` rows and upsert them.

    With ``centroids`` the new and changed rows are assigned to their nearest list.
    """
    from findry.operators import ivf

    new = with_defaults(rows, id_from).withColumn("embedding", embed(F.col("content"), embedder))
    if centroids is not None:
        new = ivf.assign(new, centroids)
    return upsert(base, new, order_by)


def request(spark, ids: Sequence, id_type: T.DataType | None = None) -> DataFrame:
    """A list of ids as a ``(position, id)`` request table."""
    schema = T.StructType([T.StructField("position", T.LongType()),
                           T.StructField("id", id_type or T.StringType())])
    return spark.createDataFrame(list(enumerate(ids)), schema)


def get_by_ids(corpus: DataFrame, requests: DataFrame,
               columns: Sequence[str] = ("content", "metadata")) -> DataFrame:
    """Documents for a ``(position, id)`` request, in request order.

    Ids the corpus lacks are skipped; repeated ids give repeated rows.  ``columns`` names what is wanted of a
    document: join and sort move these only, once for every request, so what is derived from a text is best
    derived in the corpus.
    """
    wanted = broadcast_if_small(requests.select("position", "id"))
    parts = [c for c in columns if c in corpus.columns]
    return (corpus.select("id", *parts).join(wanted, "id")
            .select("position", "id", *parts).orderBy("position"))


def delete_by_ids(corpus: DataFrame, ids: DataFrame | Sequence | None) -> DataFrame:
    """The corpus without the given ids; no ids means no change."""
    if not isinstance(ids, DataFrame):
        if not ids:
            return corpus
        ids = request(corpus.sparkSession, ids, corpus.schema["id"].dataType)
    return corpus.join(broadcast_if_small(ids.select("id").distinct()), "id", "left_anti")


def delete_by_filter(corpus: DataFrame, filter: Mapping | None, promoted_keys=None) -> DataFrame:
    """The corpus without the rows a filter matches; a filter without clauses removes none."""
    promoted = {key: (column, corpus.schema[column].dataType)
                for key, column in (promoted_keys or {}).items()}
    matched = filters.predicate(filter, promoted=promoted)
    return corpus if matched is None else corpus.filter(~matched)


def delete(corpus: DataFrame, ids=None, filter: Mapping | None = None) -> DataFrame:
    """Delete by filter if one is given, else by ids."""
    return delete_by_filter(corpus, filter) if filter else delete_by_ids(corpus, ids)
