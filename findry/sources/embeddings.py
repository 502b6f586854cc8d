"""A table of vectors that were computed before, for embedders that cost time or money.

A text is known by the SHA-256 of its UTF-8 bytes.  Only texts the table lacks reach the embedder, each once
however many rows hold it; their vectors are appended.  A failed call leaves the table as it was, and running it
again embeds what is still missing.  One table belongs to one embedder, and one writer at a time uses it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findry.functions.embed import Embedder, embed
from findry.operators.topk import broadcast_if_small
from findry.sources.lineage import fixed

DIGEST = "__digest"
SCHEMA = f"{DIGEST} string, embedding array<double>"


def digest(text):
    """What a text is known by; a null text counts as empty, as for the embedder."""
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def known(spark: SparkSession, path: str) -> DataFrame:
    """The vectors of a cache folder."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def embed_cached(rows: DataFrame, embedder: Embedder, path: str, column: str = "content") -> DataFrame:
    """``rows`` with ``embedding``, from the cache in ``path``, to which texts it lacks are added first.

    Digests are shuffled to find what is missing, and only the texts of missing ones.
    """
    spark = rows.sparkSession
    keyed = rows.drop("embedding").withColumn(DIGEST, digest(F.col(column)))
    missing = keyed.select(DIGEST).distinct().join(known(spark, path).select(DIGEST), DIGEST, "left_anti")
    with fixed(missing) as missing:
        texts = (keyed.select(DIGEST, F.col(column).alias("text")).join(broadcast_if_small(missing), DIGEST, "left_semi")
                 .groupBy(DIGEST).agg(F.first("text").alias("text")))
        # Fixed, so that the embedder sees each text once.
        with fixed(texts) as texts:
            if not texts.isEmpty():
                (texts.select(DIGEST, embed(F.col("text"), embedder).alias("embedding"))
                 .write.mode("append").parquet(path))
    return keyed.join(known(spark, path), DIGEST, "left").drop(DIGEST)
