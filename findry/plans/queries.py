"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame.

All queries read whole tables.  Query vectors are the mean vectors of the labels of
``embeddings``, query texts the whole ``benchmark`` table; text vectors are hashed bags
of words.  Floats are rounded so that results can be compared across engines.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.functions import distance as dist
from findry.functions import filters
from findry.functions.embed import HashedWords, embed, hashed_word_counts
from findry.functions.text import tokens
from findry.operators import corpus as ops
from findry.operators import hybrid, ivf, keyword, mmr, search, topk
from findry.operators.context import assemble_context
from findry.operators.topk import broadcast_if_small
from findry.schema import Columns, corpus_from_columns
from findry.sources import embeddings, storage
from findry.sources.lineage import shared_folder
from findry.sources.storage import spread

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def read(spark, folder, table) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def vectors(spark, folder) -> DataFrame:
    return read(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", "label")


def label_means(spark, folder) -> DataFrame:
    """One mean vector per label: ``(label, embedding)``."""
    return (vectors(spark, folder).groupBy("label")
            .agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
                 .alias("mean"))
            .select("label", vector_to_array("mean").alias("embedding")))


def label_queries(spark, folder) -> DataFrame:
    return label_means(spark, folder).select(F.col("label").alias("query_id"), "embedding")


def label_centroids(spark, folder) -> DataFrame:
    return label_means(spark, folder).select(
        F.col("label").alias("cid"), F.col("embedding").alias("centroid"))


def metadata_column():
    """JSON metadata of a document; short texts have no language, long ones no source."""
    return F.to_json(F.struct(
        F.when(F.col("n_chars") >= 300, F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") <= 2000, F.col("source")).alias("source"),
        F.col("n_chars").alias("n_chars")))


def documents(spark, folder) -> DataFrame:
    return read(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"),
        metadata_column().alias("metadata"))


def spread_documents(spark, folder) -> DataFrame:
    """The documents for work that is costly per text."""
    return spread(read(spark, folder, "documents"), "doc_id")


def texts(spark, folder) -> DataFrame:
    return spread_documents(spark, folder).select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"),
        metadata_column().alias("metadata"))


def embedded_documents(spark, folder) -> DataFrame:
    return texts(spark, folder).withColumn("embedding", embed(F.col("content"), HashedWords()))


def text_queries(spark, folder) -> DataFrame:
    return read(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def vectors_with_metadata(spark, folder) -> DataFrame:
    return vectors(spark, folder).select(
        "id", "embedding", F.to_json(F.struct("label")).alias("metadata"))


def rounded(frame: DataFrame, *columns: str) -> DataFrame:
    # Adding zero turns a rounded -0.0 into 0.0.
    for name in columns:
        frame = frame.withColumn(name, F.round(name, 6) + F.lit(0.0))
    return frame


# Sources and schema


@query
def corpus_scan(spark, folder):
    return ops.all_embeddings(vectors(spark, folder)).select(
        "id", F.size("embedding").alias("dim"),
        F.round(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0),
                            lambda s, x: s + x), 6).alias("total"))


@query
def corpus_validate_dim(spark, folder):
    """Vectors of odd labels lack their last element and are rejected."""
    ragged = vectors(spark, folder).select(
        "id", "label", F.slice("embedding", F.lit(1), 64 - F.col("label") % 2).alias("embedding"))
    return ops.validate_dim(ragged, 64).select("id", "label", F.size("embedding").alias("dim"))


@query
def corpus_from_columns_(spark, folder):
    table = read(spark, folder, "documents").withColumn("meta", metadata_column()).join(
        read(spark, folder, "embeddings"), F.col("doc_id") == F.col("vec_id"), "left")
    mapped = corpus_from_columns(table, Columns(
        id="doc_id", content="text", metadata="meta", embedding="embedding"))
    return mapped.select("id", F.length("content").alias("n_content"),
                         F.get_json_object("metadata", "$.source").alias("source"),
                         F.coalesce(F.size("embedding"), F.lit(0)).alias("dim"))


QUERIES["corpus_from_columns"] = QUERIES.pop("corpus_from_columns_")


@query
def vector_from_json(spark, folder):
    text = vectors(spark, folder).select("id", ops.vector_to_json(F.col("embedding")).alias("json"))
    return (text.select("id", F.posexplode(ops.vector_from_json(F.col("json"))).alias("pos", "value"))
            .transform(rounded, "value"))


# Ingest, update, lookup


@query
def embed_hash_bow(spark, folder):
    return hashed_word_counts(spread_documents(spark, folder), "doc_id", "text")


@query
def ingest_defaults(spark, folder):
    rows = read(spark, folder, "documents").select(
        F.when(F.col("lang") != "en", F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("n_chars") > 1000, metadata_column()).alias("metadata"),
        F.col("text").alias("content"))
    return ops.with_defaults(rows, id_from="content").select(
        "id", (F.col("metadata") == "{}").alias("empty"), F.length("content").alias("n_content"))


@query
def upsert(spark, folder):
    """Conversations, latest turn winning, over the documents with the same number."""
    base = documents(spark, folder).select("id", "content", "metadata")
    batch = read(spark, folder, "conversations").select(
        (F.col("conv_id") * 15).alias("id"), F.col("text").alias("content"),
        F.to_json(F.struct("role")).alias("metadata"), "turn")
    return ops.upsert(base, batch, order_by="turn").select(
        "id", "content", F.get_json_object("metadata", "$.role").alias("role"))


@query
def add_texts(spark, folder):
    """Conversations embedded, merged into the documents and put in the lists of an index."""
    base = embedded_documents(spark, folder)
    centroids = source_centroids(spark, folder)
    batch = read(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"), F.col("text").alias("content"), "turn")
    merged = ops.add_texts(ivf.assign(base, centroids), batch, HashedWords(), centroids,
                           order_by="turn")
    return merged.select("id", "cluster", F.length("content").alias("n_content"),
                         F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x).alias("n_words"))


def source_centroids(spark, folder) -> DataFrame:
    """Mean word-count vector of each source, numbered by name."""
    docs = spread_documents(spark, folder).select(
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("cid"),
        embed(F.col("text"), HashedWords()).alias("v"))
    return docs.groupBy("cid").agg(Summarizer.mean(array_to_vector("v")).alias("m")).select(
        "cid", vector_to_array("m").alias("centroid"))


@query
def get_by_ids(spark, folder):
    """The document numbered like each event's user; repeats and misses included."""
    wanted = read(spark, folder, "events").select(
        F.col("event_id").alias("position"), (F.col("user_id") * 9).alias("id"))
    docs = documents(spark, folder).withColumn("n_content", F.length("content"))
    return ops.get_by_ids(docs, wanted, ["n_content"]).select("position", "id", "n_content")


@query
def delete_by_ids(spark, folder):
    return ops.delete_by_ids(
        documents(spark, folder), read(spark, folder, "labels").select(F.col("doc_id").alias("id"))
    ).select("id", F.length("content").alias("n_content"))


@query
def delete_by_filter(spark, folder):
    return ops.delete_by_filter(
        documents(spark, folder), {"lang": {"$in": ["fr", "de"]}, "n_chars": {"$lt": 1000}}
    ).select("id")


# Filters


def filtered(name, condition):
    def run(spark, folder):
        return filters.keep(documents(spark, folder), condition).select("id")

    QUERIES[name] = run


filtered("filter_eq", {"lang": "fr"})
filtered("filter_op_eq", {"n_chars": {"$eq": 380}})
filtered("filter_ne", {"lang": {"$ne": "en"}})
filtered("filter_in", {"source": {"$in": ["src1", "src7", "nowhere"]}})
filtered("filter_nin", {"source": {"$nin": ["src1", "src7", "nowhere"]}})
filtered("filter_and", {"lang": {"$ne": "es"}, "source": {"$in": ["src2", "src3", "src5"]},
                        "n_chars": {"$gt": 500, "$lte": 1500}})


@query
def filter_range(spark, folder):
    return filters.keep(read(spark, folder, "events"), {"k": {"$gte": 50}}, metadata="props").select(
        "event_id")


# Distances and scores: every vector against the mean of its label


def to_own_mean(spark, folder) -> DataFrame:
    means = label_means(spark, folder).withColumnRenamed("embedding", "mean")
    return vectors(spark, folder).join(broadcast_if_small(means), "label")


def distances(name, metric):
    def run(spark, folder):
        away = dist.distance(metric, F.col("embedding"), F.col("mean"))
        return rounded(to_own_mean(spark, folder).select("id", away.alias("distance")), "distance")

    QUERIES[name] = run


distances("dist_cosine", "cosine")
distances("dist_dot", "dot")
distances("dist_euclidean", "euclidean")


# Vector search


@query
def knn_single(spark, folder):
    """The ten vectors nearest to the mean of them all."""
    corpus = vectors(spark, folder).select("id", "embedding")
    mean = corpus.agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))))
    found = search.knn_single(corpus, mean.first()[0].toArray(), 10)
    return rounded(found.select("id", "distance", "score"), "distance", "score")


@query
def knn_join(spark, folder):
    found = search.knn_join(vectors(spark, folder), label_queries(spark, folder), 10)
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


@query
def knn_dirty(spark, folder):
    """All metrics over vectors of which some hold NaN, null or infinity and some are null."""
    first = (F.when(F.col("label") == 0, F.lit(float("nan"))).when(F.col("label") == 3, F.lit(float("inf")))
             .when(F.col("label") != 1, F.col("embedding")[0].cast("double")))
    spoilt = F.concat(F.array(first), F.slice(F.col("embedding").cast("array<double>"), 2, 10_000))
    corpus = vectors(spark, folder).select(
        "id", F.when(F.col("label") != 2, spoilt).alias("embedding"))
    parts = [search.knn_join(corpus, label_queries(spark, folder), 5, metric).select(
        F.lit(metric).alias("metric"), "query_id", "id", "rank", "distance")
        for metric in ("cosine", "dot", "euclidean")]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), "distance")


@query
def knn_score(spark, folder):
    found = search.knn_join(vectors(spark, folder), label_queries(spark, folder), 5, "dot")
    return rounded(found.select("query_id", "id", "rank", "score"), "score")


@query
def knn_filtered(spark, folder):
    found = search.knn_join(vectors_with_metadata(spark, folder), label_queries(spark, folder), 5,
                            "euclidean", filter={"label": {"$gte": 3, "$lt": 7}})
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


@query
def search_text(spark, folder):
    found = search.search_text(embedded_documents(spark, folder), text_queries(spark, folder),
                               HashedWords(), 4)
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


def relevances(name, metric):
    def run(spark, folder):
        found = search.knn_join(vectors(spark, folder), label_queries(spark, folder), 6, metric)
        scored = search.with_relevance(found, metric)
        return rounded(scored.select("query_id", "id", "rank", "relevance"), "relevance")

    QUERIES[name] = run


relevances("relevance_cosine", "cosine")
relevances("relevance_euclidean", "euclidean")
relevances("relevance_dot", "dot")


# Keyword and hybrid search


@query
def tokenize(spark, folder):
    return spread_documents(spark, folder).select("doc_id", F.explode(tokens(F.col("text"))).alias("token"))


@query
def postings(spark, folder):
    return keyword.postings(texts(spark, folder))


@query
def keyword_overlap(spark, folder):
    found = keyword.keyword_search(texts(spark, folder), text_queries(spark, folder), 10)
    return found.select("query_id", "id", "rank", "score")


@query
def keyword_tfidf(spark, folder):
    found = keyword.keyword_search(texts(spark, folder), text_queries(spark, folder), 10,
                                   scorer="tfidf")
    return rounded(found.select("query_id", "id", "rank", "score"), "score")


@query
def keyword_indexed(spark, folder):
    """The same ranking from a postings table in place of the texts."""
    docs = texts(spark, folder)
    found = keyword.keyword_search(docs, text_queries(spark, folder), 10, scorer="tfidf",
                                   index=keyword.postings(docs))
    return rounded(found.select("query_id", "id", "rank", "score"), "score")


@query
def keyword_index_upkeep(spark, folder):
    """A stored corpus with a full-text index through an upsert and a deletion, then searched."""
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    empty = F.array().cast("array<float>").alias("embedding")
    storage.write_rows(texts(spark, folder).select("id", "content", "metadata", empty), path)
    storage.ensure_fulltext(spark, path)
    batch = read(spark, folder, "conversations").select(
        (F.col("conv_id") * 15).alias("id"), F.col("text").alias("content"),
        F.lit("{}").alias("metadata"), empty, "turn")
    storage.upsert_rows(spark, path, batch, "turn")
    storage.delete_rows(spark, path, read(spark, folder, "labels").select(F.col("doc_id").alias("id")))
    found = keyword.keyword_search(
        storage.read_rows(spark, path), text_queries(spark, folder), 10, scorer="tfidf",
        index=storage.read_fulltext(spark, path))
    return rounded(found.select("query_id", "id", "rank", "score"), "score")


@query
def upsert_columns(spark, folder):
    """A stored corpus with columns of its own; the batch lacks one of them and brings new ids."""
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    base = read(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), metadata_column().alias("metadata"),
        F.array().cast("array<float>").alias("embedding"), "lang", "source")
    storage.write_rows(base, path)
    batch = read(spark, folder, "conversations").select(
        (F.col("conv_id") * 15).alias("id"), F.col("text").alias("content"),
        F.col("role").alias("source"), "turn")
    storage.upsert_rows(spark, path, batch, "turn")
    return storage.read_rows(spark, path).select(
        "id", F.length("content").alias("n_content"), "lang", "source",
        F.get_json_object("metadata", "$.n_chars").cast("long").alias("n_chars"))


@query
def embed_cached(spark, folder):
    """Vectors of all texts through a cache that knows the English ones already."""
    path = f"{shared_folder(spark)}/vectors-{uuid.uuid4().hex}"
    docs = texts(spark, folder)
    english = docs.join(read(spark, folder, "documents").where("lang = 'en'").select(
        F.col("doc_id").alias("id")), "id", "left_semi")
    embeddings.embed_cached(english, HashedWords(), path)
    found = embeddings.embed_cached(docs, HashedWords(), path)
    return (found.select(F.col("id").alias("doc_id"), F.posexplode("embedding").alias("bucket", "n"))
            .where("n > 0").withColumn("n", F.col("n").cast("long")))


@query
def stored_changes(spark, folder):
    """A stored corpus through deletions by id and by filter, replaced rows and rows that come back."""
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    empty = F.array().cast("array<float>").alias("embedding")
    storage.write_rows(read(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), metadata_column().alias("metadata"),
        empty), path)
    labels = read(spark, folder, "labels")
    storage.delete_rows(spark, path, labels.where("quality = 0").select(F.col("doc_id").alias("id")))
    storage.upsert_rows(spark, path, labels.where("toxic = 1 or doc_id % 3 = 0").select(
        F.col("doc_id").alias("id"), F.format_string("new text of %d", "doc_id").alias("content"),
        F.lit('{"lang": "xx"}').alias("metadata"), empty))
    storage.delete_matching(spark, path, {"lang": "fr"})
    return storage.read_rows(spark, path).select(
        "id", F.length("content").alias("n_content"), F.md5("content").alias("digest"))


@query
def stored_out_of_order(spark, folder):
    """The turns of every conversation in three batches, the last turns first: the last turn stays."""
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    turns = read(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"), F.col("text").alias("content"),
        F.to_json(F.struct("role")).alias("metadata"), F.array().cast("array<float>").alias("embedding"), "turn")
    for part in (2, 0, 1):
        storage.upsert_rows(spark, path, turns.where(F.col("turn") % 3 == part), "turn")
    return storage.read_rows(spark, path).select("id", "content", "metadata")


@query
def rrf_fuse(spark, folder):
    """Nearest by cosine fused with nearest by euclidean distance."""
    corpus, wanted = embedded_documents(spark, folder), text_queries(spark, folder)
    near = search.search_text(corpus, wanted, HashedWords(), 10)
    far = search.search_text(corpus, wanted, HashedWords(), 10, "euclidean")
    return rounded(hybrid.rrf_fuse(near, far, 6, 0.7, 60), "score")


@query
def hybrid_search(spark, folder):
    found = hybrid.hybrid_search(embedded_documents(spark, folder), text_queries(spark, folder),
                                 HashedWords(), 4, 20)
    return rounded(found, "score")


@query
def hybrid_filtered(spark, folder):
    found = hybrid.hybrid_search(embedded_documents(spark, folder), text_queries(spark, folder),
                                 HashedWords(), 4, 20, filter={"lang": {"$ne": "en"}},
                                 vector_weight=0.3)
    return rounded(found, "score")


# Diversity and context


@query
def mmr_k2(spark, folder):
    found = mmr.mmr(vectors(spark, folder), label_queries(spark, folder), 2, 20)
    return rounded(found, "distance")


@query
def mmr_(spark, folder):
    found = mmr.mmr(vectors(spark, folder), label_queries(spark, folder), 4, 20, 0.3)
    return rounded(found, "distance")


QUERIES["mmr"] = QUERIES.pop("mmr_")


@query
def mmr_text(spark, folder):
    """Two of the documents nearest to each benchmark text, copies pushed aside."""
    found = mmr.mmr_text(embedded_documents(spark, folder), text_queries(spark, folder), HashedWords(),
                         k=2, fetch_k=20, lambda_mult=0.5)
    return rounded(found, "distance")


@query
def rag_context(spark, folder):
    found = search.search_text(embedded_documents(spark, folder), text_queries(spark, folder),
                               HashedWords(), 3, columns=["content"])
    return assemble_context(found)


# Approximate index: lists around the label means


def listed_vectors(spark, folder) -> DataFrame:
    return ivf.assign(vectors(spark, folder).select("id", "embedding"),
                      label_centroids(spark, folder))


@query
def ivf_assign(spark, folder):
    return listed_vectors(spark, folder).select("id", "cluster")


@query
def kmeans_step(spark, folder):
    moved = ivf.kmeans_step(vectors(spark, folder).select("id", "embedding"),
                            label_centroids(spark, folder))
    return rounded(moved.select("cid", F.posexplode("centroid").alias("pos", "value")), "value")


def vector_queries(spark, folder) -> DataFrame:
    return vectors(spark, folder).select(F.col("id").alias("query_id"), "embedding")


def twentieth(spark, folder) -> DataFrame:
    return vector_queries(spark, folder).where("query_id % 20 = 0")


@query
def knn_in_place(spark, folder):
    """Every vector whose id is divisible by 20 against all, by all metrics, from files of queries."""
    rows, parts = vectors(spark, folder).select("id", "embedding"), []
    for metric in ("cosine", "dot", "euclidean"):
        found, _ = topk.nearest_rows(rows, twentieth(spark, folder), 10, metric, budget=0)
        parts.append(found.withColumn("metric", F.lit(metric)))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(every.select("metric", "query_id", "id", "rank", "distance"), "distance")


@query
def ivf_calibrated(spark, folder):
    """A trained index probed as far as its recall curve asks for: all that exact search finds."""
    index = ivf.build_index(vectors(spark, folder).select("id", "embedding"), n_lists=16)
    asked = twentieth(spark, folder)
    nprobe = ivf.calibrate(index, asked, 1.0, 10, most=16)
    found = search.knn_join(index.rows, asked, 10, centroids=index.centroids, nprobe=nprobe)
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


@query
def ivf_probe(spark, folder):
    probed = ivf.probe(vector_queries(spark, folder), label_centroids(spark, folder), 3)
    return probed.select("query_id", F.posexplode("clusters").alias("place", "cluster"))


@query
def ivf_search(spark, folder):
    found = search.knn_join(listed_vectors(spark, folder), label_queries(spark, folder), 5,
                            centroids=label_centroids(spark, folder), nprobe=2)
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


@query
def ivf_incremental(spark, folder):
    """Every vector reversed, under twice its number: half replace rows, half are new."""
    centroids = label_centroids(spark, folder)
    batch = vectors(spark, folder).select(
        (F.col("id") * 2).alias("id"), F.reverse("embedding").alias("embedding"))
    return ops.upsert(listed_vectors(spark, folder), ivf.assign(batch, centroids)).select(
        "id", "cluster")


@query
def ivf_build(spark, folder):
    """A trained index, all of its lists probed: equal to exact search."""
    index = ivf.build_index(vectors(spark, folder).select("id", "embedding"), n_lists=16, nprobe=16)
    found = search.knn_join(index.rows, label_queries(spark, folder), 10,
                            centroids=index.centroids, nprobe=16)
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


@query
def ivf_train_sparse(spark, folder):
    """Lists trained on a table of which nine rows in ten have no vector; all of them probed."""
    sparse = vectors(spark, folder).select(
        "id", F.when(F.col("label") == 4, F.col("embedding")).alias("embedding"))
    index = ivf.build_index(sparse, n_lists=8, sample=30, nprobe=8)
    found = search.knn_join(index.rows, label_queries(spark, folder), 5,
                            centroids=index.centroids, nprobe=8)
    return rounded(found.select("query_id", "id", "rank", "distance"), "distance")


@query
def kmeans_rounds(spark, folder):
    """Three rounds of the training loop, started from the label means."""
    moved = ivf.kmeans(vectors(spark, folder).select("id", "embedding"),
                       label_centroids(spark, folder), 3)
    return rounded(moved.select("cid", F.posexplode("centroid").alias("pos", "value")), "value")


@query
def ivf_centroids(spark, folder):
    """Trained lists and their sizes."""
    index = ivf.build_index(vectors(spark, folder).select("id", "embedding"), n_lists=16)
    return index.rows.groupBy("cluster").agg(F.count("*").alias("n_rows"))


@query
def recall_at_k(spark, folder):
    wanted = label_queries(spark, folder)
    exact = search.knn_join(vectors(spark, folder), wanted, 10)
    found = search.knn_join(listed_vectors(spark, folder), wanted, 10,
                            centroids=label_centroids(spark, folder), nprobe=2)
    return rounded(ivf.recall(found, exact), "recall")


@query
def ivf_scan_fraction(spark, folder):
    probes = ivf.probe(vector_queries(spark, folder), label_centroids(spark, folder), 2)
    return rounded(ivf.scan_fraction(listed_vectors(spark, folder), probes), "fraction")
