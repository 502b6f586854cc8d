"""A stored corpus with the operators bound to it.

Searches take one text (or vector) or a DataFrame of queries alike and return DataFrames
of ranked results with ``content`` and ``metadata``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.functions import filters
from findry.functions.embed import Embedder, embed
from findry.operators import corpus as ops
from findry.operators import hybrid, ivf, keyword, mmr, search
from findry.operators.context import assemble_context
from findry.schema import check_metric, corpus_schema
from findry.sources import storage
from findry.sources.lineage import cut_lineage

SHOWN = ("content", "metadata")


def _json(metadata: Mapping | str | None) -> str | None:
    """Metadata as the JSON text of an object."""
    if metadata is None:
        return None
    if isinstance(metadata, Mapping):
        return json.dumps(dict(metadata), ensure_ascii=False)
    try:
        if isinstance(metadata, str) and isinstance(json.loads(metadata), dict):
            return metadata
    except ValueError:
        pass
    raise ValueError(f"metadata must be a mapping or JSON text of an object, got {metadata!r}")


class Collection:
    """A folder of versions; building an index writes a new one, other changes update it."""

    def __init__(self, spark: SparkSession, path: str, embedder: Embedder | None = None,
                 metric: str = "cosine", nprobe: int = ivf.DEFAULT_NPROBE,
                 promoted_keys: Mapping[str, str] | None = None,
                 promoted_types: Mapping[str, str] | None = None, double: bool = False):
        """``promoted_keys`` maps metadata keys to columns of their own.

        These are filled from the metadata when texts are added; filters on them reach the scan.
        ``promoted_types`` names the types of those that are not strings.  New corpora hold 32-bit
        vectors, or 64-bit ones if ``double``.
        """
        self.spark, self.path, self.embedder = spark, path.rstrip("/"), embedder
        self.metric, self.nprobe = check_metric(metric), nprobe
        self.element = T.DoubleType() if double else T.FloatType()
        self.promoted, self.kinds = dict(promoted_keys or {}), dict(promoted_types or {})

    @classmethod
    def from_texts(cls, spark: SparkSession, path: str, texts, embedder: Embedder,
                   metadatas: Sequence[Mapping | str] | None = None,
                   ids: Sequence[str] | None = None, metric: str = "cosine",
                   **promoted) -> Collection:
        made = cls(spark, path, embedder, metric, **promoted)
        made.add_texts(texts, metadatas, ids)
        return made

    def _version(self) -> tuple[int, str]:
        return storage.current_folder(self.spark, self.path, f"{self.path}/rows-0")

    def folder(self) -> str:
        return self._version()[1]

    def _switch(self, write: Callable[[str], None]) -> None:
        """Write a new folder, then make it current; a failed attempt is never seen."""
        version, before = self._version()
        folder = f"{self.path}/rows-{version + 1}-{uuid.uuid4().hex}"
        # Rows changed meanwhile would be lost, so a change of the corpus is noticed.
        seen = storage.changes_of(self.spark, before)
        write(folder)
        if self._version()[0] != version or storage.changes_of(self.spark, before) != seen:
            raise RuntimeError("the corpus changed while it was being written anew; try again")
        storage.add_version(self.spark, self.path, version + 1, folder)

    def rows(self) -> DataFrame:
        rows = storage.read_rows(self.spark, self.folder())
        if rows is None:
            schema = corpus_schema(element=self.element).add("cluster", "int")
            for key, column in self.promoted.items():
                schema = schema.add(column, self.kinds.get(key, "string"))
            return self.spark.createDataFrame([], schema)
        return rows

    # Changing

    def add_texts(self, texts, metadatas: Sequence[Mapping | str] | None = None,
                  ids: Sequence[str] | None = None) -> list[str] | None:
        """Embed and upsert texts, keeping the index current.

        ``texts`` is a DataFrame ``(content[, id, metadata])`` or a list, for which the ids
        are returned.  Metadata is a mapping or JSON text of an object.
        """
        if isinstance(texts, DataFrame):
            batch, order = ops.with_defaults(texts), None
        else:
            texts = list(texts)
            if not texts:
                return []
            ids, metadatas = list(ids or []), [_json(m) for m in metadatas or []]
            blanks = [None] * len(texts)
            listed = list(zip(range(len(texts)), texts, ids + blanks, metadatas + blanks))
            batch = ops.with_defaults(self.spark.createDataFrame(
                listed, "position long, content string, id string, metadata string"))
            order = "position"
        # Random ids are fixed before use: the ids returned are the ids stored.
        batch = cut_lineage(batch)
        embedded = batch.withColumn("embedding", embed(F.col("content"), self.embedder)
                                    .cast(T.ArrayType(self.element)))
        for key, column in self.promoted.items():
            if column not in embedded.columns:
                embedded = embedded.withColumn(column, filters.promoted_value(
                    F.col("metadata"), key, self.kinds.get(key, "string")))
        if order:  # the later of equal ids in this list; places in it mean nothing to other calls
            embedded = ops.latest(embedded, order).drop(order)
        storage.upsert_rows(self.spark, self.folder(), embedded)
        if order:
            return [row["id"] for row in batch.orderBy(order).select("id").collect()]
        return None

    def delete(self, ids=None, filter: Mapping | None = None) -> bool:
        """Delete by filter if one is given, else by ids; False if neither is."""
        if filter:
            storage.delete_matching(self.spark, self.folder(), filter, self.promoted)
            return True
        if ids is None or (not isinstance(ids, DataFrame) and not list(ids)):
            return False
        if not isinstance(ids, DataFrame):
            ids = ops.request(self.spark, list(ids), self.rows().schema["id"].dataType)
        storage.delete_rows(self.spark, self.folder(), ids)
        return True

    def build_index(self, n_lists: int = 100, sample: int | None = None, iters: int = 10,
                    nprobe: int = ivf.DEFAULT_NPROBE, seed: int = 0) -> None:
        """Build (or rebuild) the list index; searches then scan ``nprobe`` lists a query."""
        index = ivf.build_index(self.rows(), n_lists, sample, iters, nprobe, seed)
        fulltext = storage.has_fulltext(self.spark, self.folder())

        def write(folder: str) -> None:
            storage.write_index(index, folder)
            if fulltext:
                storage.ensure_fulltext(self.spark, folder)

        self._switch(write)
        self.nprobe = nprobe

    def ensure_fulltext_index(self) -> None:
        """Build the full-text index if there is none; all later changes keep it up.

        Keyword and hybrid searches then rank by full-text relevance unless told otherwise, and read
        the postings of the asked words in place of all texts.
        """
        storage.ensure_fulltext(self.spark, self.folder())

    def compact(self) -> None:
        """Write the live rows anew, without those replaced or deleted."""
        before = self.folder()
        self._switch(lambda folder: storage.compact(self.spark, before, folder))

    # Searching

    def get_by_ids(self, ids) -> DataFrame:
        rows = self.rows()
        if not isinstance(ids, DataFrame):
            ids = ops.request(self.spark, list(ids), rows.schema["id"].dataType)
        # The directory names the files to read.
        held = storage.read_rows(self.spark, self.folder(), ids.select("id").distinct())
        return ops.get_by_ids(rows if held is None else held, ids)

    def _asked(self, queries) -> DataFrame:
        if isinstance(queries, DataFrame):
            return queries
        if isinstance(queries, str):
            return self.spark.createDataFrame([(0, queries)], "query_id long, text string")
        vector = [float(x) for x in queries]
        return self.spark.createDataFrame([(0, vector)], "query_id long, embedding array<double>")

    def _embedded(self, queries) -> DataFrame:
        queries = self._asked(queries)
        return queries if "embedding" in queries.columns else search.embed_queries(
            queries, self.embedder)

    def _options(self) -> dict:
        return {"centroids": storage.read_centroids(self.spark, self.folder()),
                "default_nprobe": self.nprobe, "metric": self.metric, "columns": SHOWN,
                "promoted_keys": self.promoted}

    def similarity_search(self, queries, k: int = 4, filter: Mapping | None = None,
                          nprobe: int | None = None) -> DataFrame:
        """Nearest rows with ``distance`` and ``score``, by text or by vector."""
        return search.knn_join(self.rows(), self._embedded(queries), k, filter=filter,
                               nprobe=nprobe, **self._options())

    def similarity_search_with_relevance_scores(self, queries, k: int = 4,
                                                filter: Mapping | None = None,
                                                nprobe: int | None = None) -> DataFrame:
        """The same with ``relevance`` in [0, 1]."""
        return search.with_relevance(self.similarity_search(queries, k, filter, nprobe), self.metric)

    def _words(self, scorer: str | None) -> dict:
        """The scorer of a keyword search, and the index if there is one for it."""
        index = storage.read_fulltext(self.spark, self.folder()) if scorer in (None, "tfidf") else None
        return {"scorer": scorer or ("overlap" if index is None else "tfidf"), "index": index}

    def keyword_search(self, queries, k: int = 4, filter: Mapping | None = None,
                       scorer: str | None = None) -> DataFrame:
        return keyword.keyword_search(self.rows(), self._asked(queries), k, filter, columns=SHOWN,
                                      promoted_keys=self.promoted, **self._words(scorer))

    def hybrid_search(self, queries, k: int = 4, fetch_k: int = 20, filter: Mapping | None = None,
                      vector_weight: float = 0.5, rrf_k: int = 60, nprobe: int | None = None,
                      scorer: str | None = None) -> DataFrame:
        hybrid.check_weight(vector_weight)
        return hybrid.hybrid_search(
            self.rows(), self._embedded(queries), None, k, fetch_k, filter, vector_weight, rrf_k,
            nprobe=nprobe, **self._words(scorer), **self._options())

    def max_marginal_relevance_search(self, queries, k: int = 4, fetch_k: int = 20,
                                      lambda_mult: float = 0.5, filter: Mapping | None = None,
                                      nprobe: int | None = None) -> DataFrame:
        return mmr.mmr(self.rows(), self._embedded(queries), k, fetch_k, lambda_mult,
                       filter=filter, nprobe=nprobe, **self._options())

    def context(self, queries, k: int = 4, **options) -> DataFrame:
        """The contents of each query's results as one passage, best first."""
        return assemble_context(self.similarity_search(queries, k, **options))
