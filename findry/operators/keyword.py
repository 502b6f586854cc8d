"""Keyword search: documents ranked by the query words they contain.

Two scorers.  ``overlap`` counts the distinct query words a document holds.  ``tfidf``
follows the relevance formula of InnoDB full-text search, the sum over shared words of
``tf * idf ** 2`` with ``idf = log10(documents / documents with the word)``, and leaves
out short and stop words.  Its words are of any script; a word that every document holds
keeps a small weight (``LEAST_IDF``), so that its repeats still rank.

Documents are scored one at a time against all queries inside the scan, so a word that
most documents and most queries share costs no join output: each task passes on ``k``
rows per query and nothing is shuffled by word.  A task holds a cell for each document and query that
share a word, and no others, in slices of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.functions import filters, kernels
from findry.functions.text import (
    MIN_TOKEN_LENGTH, STOP_WORDS, index_words, term_bucket, text_words, tokens, words)
from findry.operators import topk
from findry.schema import check_count
from findry.sources.chunks import cut_into_chunks
from findry.sources.lineage import cut_lineage

SCORERS = ("overlap", "tfidf")
# Fixed value: the idf InnoDB gives to a word that all documents hold.
LEAST_IDF = math.log10(1.0001)
# Words of documents that a task looks up at once; bounds its scratch memory.
TERMS_AT_ONCE = 250_000


def postings(corpus: DataFrame, scorer: str = "tfidf") -> DataFrame:
    """The inverted index: ``(term, id, tf)`` for every word of every document.

    The words are those of a scorer, which alone the index then serves; ASCII words are the same to both.

    Grouping by word and document keeps the word counts of common words spread out, and
    a document's repeats are combined before the shuffle.
    """
    split = text_words if scorer == "tfidf" else words
    return (corpus.select("id", F.explode(split(F.col("content"))).alias("term"))
            .groupBy("term", "id").agg(F.count("*").cast("int").alias("tf")))


def keyword_search(corpus: DataFrame, queries: DataFrame, k: int = 4,
                   filter: Mapping | None = None, scorer: str = "overlap",
                   index: DataFrame | None = None, columns=(), *,
                   min_length: int = MIN_TOKEN_LENGTH, stop_words=STOP_WORDS,
                   promoted_keys: Mapping[str, str] | None = None) -> DataFrame:
    """The ``k`` best documents of every ``(query_id, text)`` query that share a word with it.

    ``index`` is a postings table of the same corpus; with it only the postings of the
    query words are read in place of the texts.  ``distance`` is the negated score.
    """
    found, most = find_keywords(corpus, queries, k, filter, scorer, index, min_length,
                                stop_words, promoted_keys)
    found = found.withColumn("score", -F.col("distance")).select(
        "query_id", "id", "distance", "score", "rank")
    return topk.look_up(found, corpus, list(columns), most) if columns else found


def find_keywords(corpus, queries, k, filter=None, scorer="overlap", index=None,
                  min_length=MIN_TOKEN_LENGTH, stop_words=STOP_WORDS,
                  promoted_keys=None) -> tuple[DataFrame, int]:
    check_count("k", k)
    if scorer not in SCORERS:
        raise ValueError(f"unknown scorer {scorer!r}; use one of {', '.join(SCORERS)}")
    rows = filters.keep(corpus, filter, promoted_keys=promoted_keys)
    if scorer == "overlap":
        wanted = queries.select("query_id", tokens(F.col("text")).alias("terms"))
        wanted = wanted.withColumn("weights", F.transform("terms", lambda t: F.lit(1.0)))
    else:
        wanted = _weighted(corpus, queries, index, min_length, stop_words)
        # The words of the whole corpus are counted once, also where many queries are looked at twice.
        few = queries.select("query_id").limit(topk.FIRST_LOOK_ROWS + 1).count() <= topk.FIRST_LOOK_ROWS
        wanted = wanted if few else cut_lineage(wanted)
    side = topk.measure(wanted, "terms", topk.BROADCAST_BYTES // 4, per_row=32 + 24 * k,
                        even=False)
    if index is not None:
        documents = _from_postings(index, side, scorer)
        if filter:
            documents = documents.join(rows.select("id"), "id", "left_semi")
    else:
        # Repeats matter only to tf; the kernel counts them.
        part = tokens if scorer == "overlap" else text_words
        documents = rows.select("id", part(F.col("content")).alias("terms"))
    if side.local is not None:
        partials = _scan(documents, side, k)
    else:
        partials = _in_place(documents, side, wanted, k)
    return topk.best_per_query(partials, k), side.rows * k


def _weighted(corpus, queries, index, min_length, stop_words) -> DataFrame:
    """Queries as ``terms`` with their squared idf as ``weights``; unknown words are gone."""
    asked = queries.select(
        "query_id",
        F.explode(F.array_distinct(index_words(F.col("text"), min_length, stop_words))).alias("term"))
    # Short and stop words are gone from the asked words, so the held ones need no check.
    if index is not None:
        held = index.select("term")
    else:
        held = corpus.select(F.explode(F.array_distinct(text_words(F.col("content")))).alias("term"))
    vocabulary = asked.select("term").distinct()
    if vocabulary.count() <= topk.BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)
    known = (held.join(vocabulary, "term", "left_semi")
             .groupBy("term").agg(F.count("*").alias("df")))
    total = F.lit(float(corpus.count()))
    idf = F.when(F.col("df") >= total, F.lit(LEAST_IDF)).otherwise(F.log10(total / F.col("df")))
    return (
        asked.join(known.select("term", (idf * idf).alias("weight")), "term")
        .groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("tw"))
        .select("query_id", F.col("tw.term").alias("terms"), F.col("tw.weight").alias("weights")))


def _from_postings(index, side: topk.Side, scorer) -> DataFrame:
    """Documents rebuilt from the postings of the query words.

    A document's list is no longer than the set of query words.  A stored table's
    folders that hold none of them are not read.
    """
    if side.local is not None:
        asked = pc.unique(side.local.column("terms").combine_chunks().flatten())
        vocabulary = F.broadcast(
            side.frame.sparkSession.createDataFrame(pa.table({"term": asked}), "term string"))
        if "bucket" in index.columns:
            buckets = vocabulary.select(term_bucket(F.col("term"))).distinct().collect()
            index = index.filter(F.col("bucket").isin([row[0] for row in buckets]))
    else:
        vocabulary = side.frame.select(F.explode("terms").alias("term")).distinct()
    hits = index.join(vocabulary, "term", "left_semi")
    listed = hits.groupBy("id").agg(F.collect_list(F.struct("term", "tf")).alias("hits"))
    columns = ["id", F.col("hits.term").alias("terms")]
    if scorer == "tfidf":
        columns.append(F.col("hits.tf").alias("counts"))
    return listed.select(*columns)


def _query_terms(table: pa.Table) -> dict:
    """Query words as lists per word: see :class:`kernels.BestMatches`."""
    lists = table.column("terms").combine_chunks()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    flat = lists.flatten()
    vocab = pc.unique(flat)
    vocab = vocab.take(pc.sort_indices(vocab))
    term = pc.index_in(flat, value_set=vocab).to_numpy()
    order = np.lexsort((owner, term))
    weights = table.column("weights").combine_chunks().flatten().to_numpy()
    return {"vocab": vocab, "n_queries": len(lists), "who": owner[order],
            "weight": weights[order],
            "starts": np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(vocab)))])}


def _add(best: kernels.BestMatches, batch) -> None:
    """Offers the documents of a batch, in parts of ``TERMS_AT_ONCE`` words or one document."""
    sizes = pc.fill_null(pc.list_value_length(kernels.one_array(batch.column("terms"))), 0).to_numpy()
    ends, at = np.cumsum(sizes.astype(np.int64)), 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + TERMS_AT_ONCE, side="right")))
        _add_part(best, batch.slice(at, end - at))
        at = end


def _add_part(best: kernels.BestMatches, batch) -> None:
    lists = kernels.one_array(batch.column("terms"))
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    counts = None
    if "counts" in batch.schema.names:
        counts = kernels.one_array(batch.column("counts")).flatten().to_numpy()
    best.add(kernels.one_array(batch.column("id")), row, lists.flatten(), counts)


def _scan(documents, side: topk.Side, k) -> DataFrame:
    shared = {"query_ids": side.local.column("query_id").combine_chunks(),
              "terms": _query_terms(side.local)}

    def start(values):
        return kernels.BestMatches(values["terms"], k), _add

    return topk.scan_with(documents, "terms", shared, start, side.frame.schema["query_id"].dataType)


def _in_place(documents, side: topk.Side, queries, k) -> DataFrame:
    """Too many queries to send around: they are written as files which the tasks of the scan read."""
    per_chunk = max(1, topk.BLOCK_BYTES // (64 * max(1, side.dim)))
    written = cut_into_chunks(queries, side.rows, per_chunk)

    def start(held):
        part = TaskContext.get().partitionId()

        def score(chunk):
            if not pc.sum(pc.list_value_length(chunk.column("terms"))).as_py():
                return None
            best = kernels.BestMatches(_query_terms(chunk), k)
            _add(best, held)
            return topk.partial_batch(best, kernels.one_array(chunk.column("query_id")), part)

        return score

    schema = topk.partial_schema(queries.schema["query_id"].dataType, documents.schema["id"].dataType)
    return written.scan(documents, "terms", start, schema, topk.BLOCK_BYTES)
