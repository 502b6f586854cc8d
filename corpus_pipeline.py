"""A training corpus from raw documents: language, near-copies, repeated passages, personal data, packing.

``STAGES`` are applied in order, each to all the one before kept, through written tables.  Extra
columns of the documents pass through every stage but the last.

Texts of any length are taken whole.  Repeated rows are documents of their own until near-copies go: of equal or near
texts the one of least doc_id stays.  Null and empty texts are of no language and go with the first stage, unless no
language can be learned.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findry.llm import langid, packing, simhash, spans, surrogates
from findry.llm.scratch import Scratch

# Fingerprints, graphs and cuts of dynamic programming have no SQL form.
ORACLE_SQL = None


def _beside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], *added: str) -> DataFrame:
    """``stage(docs)`` with the columns of ``docs`` only, though some are named as those it adds."""
    away = {c: f"__own_{c}" for c in docs.columns if c.lower() in added}
    back = {new: old for old, new in away.items()}
    done = stage(docs.withColumnsRenamed(away)).drop(*added)
    return done.withColumnsRenamed(back).select(*docs.columns)


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if there is such a column, counted anew."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the model of some language accepts; all if no language can be learned."""
    model = langid.train(docs)
    if model is None:
        return docs
    return _beside(docs, lambda d: langid.identify(d, model).where("not rejected"),
                   "lang_pred", "score", "rejected")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stood before; documents of which nothing is left go."""
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"\S")
    return _counted(_beside(docs, lambda d: spans.clean(d).where(left), "n_removed", "removed"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(_beside(docs, surrogates.pseudonymise, "entities"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("PII", replace_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per piece of a packed sequence."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = scratch.keep(docs, f"stage{number}")
            scratch.drop(f"stage{number - 1}")
    return docs
