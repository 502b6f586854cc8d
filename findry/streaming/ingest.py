"""Keeping an indexed corpus current from a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from findry.functions.embed import Embedder, embed
from findry.operators.corpus import with_defaults
from findry.sources import storage


def stream_into(documents: DataFrame, path: str, checkpoint: str, embedder: Embedder | None = None,
                order_by: str | None = None, **trigger) -> StreamingQuery:
    """Upsert a stream of ``(id, content, metadata[, embedding])`` into a corpus folder.

    ``order_by`` names the column that says which row of an id is the latest; a stream has no other order.  Its
    values are kept with the corpus, so a row that arrives after a later one of its id changes nothing,
    in whichever micro-batch it comes.

    Every micro-batch is assigned to the lists of the index and upserted by id, so a
    batch that is run again after a failure leaves the same rows.  Ids that are absent
    are derived from the text for the same reason.
    """

    if order_by is None:
        raise ValueError("a stream needs order_by: its rows arrive in no certain order")

    def apply(batch: DataFrame, _epoch: int) -> None:
        if batch.isEmpty():
            return
        batch = with_defaults(batch, id_from="content")
        if embedder is not None:
            batch = batch.withColumn("embedding", embed(F.col("content"), embedder))
        storage.upsert_rows(batch.sparkSession, path, batch, order_by)

    return (documents.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
