"""The same results in plain SQL, for checking with another engine."""

from __future__ import annotations

from findry.functions.text import MIN_TOKEN_LENGTH, STOP_WORDS

VECTORS = """
vec AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
means AS (
  SELECT label, list(m ORDER BY pos) AS e FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, unnest(range(len(e))) AS pos, unnest(e) AS x FROM vec)
    GROUP BY label, pos)
  GROUP BY label)"""

WORDS = "unnest(regexp_extract_all(lower({text}), '[a-z0-9]+'))"
# Words of any script, for full-text relevance.
TEXT_WORDS = "unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'))"
BUCKET = """CAST((strpos('0123456789abcdef', substr(md5(w), 31, 1)) - 1) * 16 % 64
  + (strpos('0123456789abcdef', substr(md5(w), 32, 1)) - 1) AS INTEGER) % 64"""


def bags(name: str, table: str, key: str, text: str = "text") -> str:
    """Hashed word-count vectors ``name(id, e)`` of a table's texts."""
    return f"""
{name}_n AS (
  SELECT id, {BUCKET} AS b, count(*) AS n
  FROM (SELECT {key} AS id, {WORDS.format(text=text)} AS w FROM {table}) GROUP BY ALL),
{name} AS (
  SELECT k.id, list(CAST(coalesce(n, 0) AS DOUBLE) ORDER BY k.b) AS e
  FROM (SELECT {key} AS id, unnest(range(64)) AS b FROM {table}) k
  LEFT JOIN {name}_n c ON c.id = k.id AND c.b = k.b GROUP BY k.id)"""


def norm(v: str) -> str:
    return f"sqrt(list_inner_product({v}, {v}))"


def cosine(a: str, b: str) -> str:
    return (f"(CASE WHEN {norm(a)} * {norm(b)} = 0 THEN 0e0 ELSE "
            f"list_inner_product({a}, {b}) / ({norm(a)} * {norm(b)}) END)")


def distance(metric: str, a: str, b: str) -> str:
    return {"cosine": f"(1e0 - {cosine(a, b)})",
            "dot": f"(-list_inner_product({a}, {b}))",
            "euclidean": f"list_distance({a}, {b})"}[metric]


def nearest(name: str, corpus: str, queries: str, k: int, metric: str = "cosine",
            where: str = "true") -> str:
    """``name(query_id, id, distance, rank)``: the k rows of a corpus per query."""
    return f"""
{name} AS (
  SELECT query_id, id, distance, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM (
      SELECT q.query_id, c.id, {distance(metric, 'c.e', 'q.e')} AS distance
      FROM {corpus} c, {queries} q WHERE {where}))
  WHERE rank <= {k})"""


def six(column: str, name: str | None = None) -> str:
    return f"round({column}, 6) + 0e0 AS {name or column}"


METRICS = ("cosine", "dot", "euclidean")
TWENTIETH = "asked AS (SELECT id AS query_id, e FROM vec WHERE id % 20 = 0)"
LABEL_QUERIES = "asked AS (SELECT label AS query_id, e FROM means)"
TEXT_QUERIES = (bags("asked_bags", "benchmark", "item_id")
                + ",\nasked AS (SELECT id AS query_id, e FROM asked_bags)")
BAG_SEARCH = bags("bag", "documents", "doc_id") + "," + TEXT_QUERIES

DOCS = """
docs AS (
  SELECT doc_id AS id, text,
    CASE WHEN n_chars >= 300 THEN lang END AS lang,
    CASE WHEN n_chars <= 2000 THEN source END AS source, n_chars
  FROM documents)"""

OVERLAP = f"""
doc_words AS (SELECT DISTINCT doc_id AS id, {WORDS.format(text='text')} AS w FROM documents),
asked_words AS (SELECT DISTINCT item_id AS query_id, {WORDS.format(text='text')} AS w FROM benchmark)"""


def overlap(name: str, k: int, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
      SELECT query_id, id, CAST(count(*) AS DOUBLE) AS score
      FROM doc_words JOIN asked_words USING (w) WHERE {where} GROUP BY query_id, id))
  WHERE rank <= {k})"""


def fuse(name: str, left: str, right: str, k: int, weight: float) -> str:
    return f"""
{name} AS (
  SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (
      PARTITION BY query_id ORDER BY score DESC, v NULLS LAST, w NULLS LAST, id) AS rank FROM (
        SELECT query_id, id, a.rank AS v, b.rank AS w,
          coalesce({weight}e0 / (60 + a.rank), 0e0)
          + coalesce((1e0 - {weight}e0) / (60 + b.rank), 0e0) AS score
        FROM {left} a FULL OUTER JOIN {right} b USING (query_id, id)))
  WHERE rank <= {k})"""


def tfidf(k: int, source: str = "") -> str:
    """Full-text relevance of ``documents``, or of the table ``source`` defines over them."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    keep = f"length(w) >= {MIN_TOKEN_LENGTH} AND w NOT IN ({stop})"
    return f"""
WITH {source}tf AS (
  SELECT id, w, count(*) AS tf
  FROM (SELECT doc_id AS id, {TEXT_WORDS.format(text='text')} AS w FROM documents)
  WHERE {keep} GROUP BY id, w),
idf AS (
  SELECT w, CASE WHEN n = total THEN log10(1.0001) ELSE log10(total / n) END AS idf FROM (
    SELECT w, count(*) AS n, (SELECT CAST(count(*) AS DOUBLE) FROM documents) AS total
    FROM tf GROUP BY w)),
asked_words AS (
  SELECT * FROM (SELECT DISTINCT item_id AS query_id, {TEXT_WORDS.format(text='text')} AS w FROM benchmark)
  WHERE {keep}),
scored AS (
  SELECT query_id, id, sum(tf * (idf * idf) ORDER BY w) AS score
  FROM tf JOIN idf USING (w) JOIN asked_words USING (w) GROUP BY query_id, id)
SELECT query_id, id, CAST(rank AS INTEGER) AS rank, {six('score')} FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored)
WHERE rank <= {k}"""


LISTS = """
listed AS (
  SELECT id, label, e, (SELECT m.label FROM means m ORDER BY list_distance(m.e, v.e), m.label LIMIT 1)
    AS cluster FROM vec v)"""


def probes(source: str, n: int) -> str:
    return f"""
probes AS (
  SELECT query_id, place, cluster FROM (
    SELECT q.query_id, m.label AS cluster, CAST(row_number() OVER (
      PARTITION BY q.query_id ORDER BY list_distance(m.e, q.e), m.label) - 1 AS INTEGER) AS place
    FROM {source} q, means m)
  WHERE place < {n})"""


def probed(name: str, k: int) -> str:
    return nearest(name, "listed", "asked", k, where=(
        "EXISTS (SELECT 1 FROM probes p WHERE p.query_id = q.query_id AND p.cluster = c.cluster)"))


def diverse(k: int, balance: float, source: str = "", corpus: str = "vec") -> str:
    """Greedy picking, written out one step after another."""
    picks = [f"""
pick1 AS (
  SELECT *, 1 AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {balance}e0 * sim DESC, near_rank) AS n
    FROM cand) WHERE n = 1)"""]
    for step in range(2, k + 1):
        before = " UNION ALL ".join(f"SELECT query_id, id, e FROM pick{i}" for i in range(1, step))
        picks.append(f"""
taken{step} AS ({before}),
left{step} AS (
  SELECT c.query_id, c.id, max({cosine('c.e', 't.e')}) AS alike
  FROM cand c JOIN taken{step} t ON t.query_id = c.query_id
  GROUP BY c.query_id, c.id HAVING NOT bool_or(t.id = c.id)),
pick{step} AS (
  SELECT * EXCLUDE (alike), {step} AS rank FROM (
    SELECT cand.*, alike, row_number() OVER (
      PARTITION BY query_id ORDER BY {balance}e0 * sim - (1e0 - {balance}e0) * alike DESC, near_rank)
      AS n
    FROM cand JOIN left{step} USING (query_id, id)) WHERE n = 1)""")
    every = " UNION ALL ".join(
        f"SELECT query_id, id, distance, near_rank, rank FROM pick{i}" for i in range(1, k + 1))
    return f"""
WITH {source or f'{VECTORS}, {LABEL_QUERIES}'}, {nearest('near', corpus, 'asked', 20)},
cand AS (
  SELECT near.query_id, near.id, distance, near.rank AS near_rank, held.e,
    {cosine('held.e', 'asked.e')} AS sim
  FROM near JOIN {corpus} held USING (id) JOIN asked USING (query_id)),{','.join(picks)}
SELECT query_id, id, near_rank, rank, {six('distance')} FROM ({every})"""


def label_search(k: int, metric: str = "cosine", value: str = "distance", as_: str | None = None,
                 where: str = "true") -> str:
    return f"""
WITH {VECTORS}, {LABEL_QUERIES}, {nearest('near', 'vec', 'asked', k, metric, where)}
SELECT query_id, id, rank, {six(value, as_ or value)} FROM near"""


def filtered(where: str) -> str:
    return f"WITH {DOCS} SELECT id FROM docs WHERE {where}"


def to_mean(metric: str) -> str:
    return f"""
WITH {VECTORS} SELECT id, {six(distance(metric, 'vec.e', 'means.e'), 'distance')}
FROM vec JOIN means USING (label)"""


def dirty() -> str:
    parts = {m: nearest(f"near_{m}", "vec", "asked", 5, m, "c.label NOT IN (0, 1, 2, 3)")
             for m in ("cosine", "dot", "euclidean")}
    rows = " UNION ALL ".join(f"SELECT '{m}' AS metric, query_id, id, rank, {six('distance')} FROM near_{m}"
                              for m in parts)
    return f"WITH {VECTORS}, {LABEL_QUERIES}, {','.join(parts.values())} {rows}"


def rounds(n: int) -> str:
    """Lloyd steps from the label means, written out one after another."""
    steps = ["c0 AS (SELECT label AS cid, e FROM means)"]
    for i in range(n):
        steps.append(f"""
l{i} AS (
  SELECT e, (SELECT c.cid FROM c{i} c ORDER BY list_distance(c.e, v.e), c.cid LIMIT 1) AS cid FROM vec v),
m{i} AS (
  SELECT cid, pos, avg(x) AS x FROM (
    SELECT cid, unnest(range(len(e))) AS pos, unnest(e) AS x FROM l{i}) GROUP BY cid, pos),
c{i + 1} AS (
  SELECT c.cid, coalesce(m.e, c.e) AS e FROM c{i} c
  LEFT JOIN (SELECT cid, list(x ORDER BY pos) AS e FROM m{i} GROUP BY cid) m ON m.cid = c.cid)""")
    return f"""
WITH {VECTORS}, {', '.join(steps)}
SELECT cid, CAST(pos AS INTEGER) AS pos, {six('x', 'value')} FROM (
  SELECT cid, unnest(range(len(e))) AS pos, unnest(e) AS x FROM c{n})"""


ORACLES = {
    "corpus_scan": """
SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
  round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
    "corpus_validate_dim": """
SELECT vec_id AS id, label, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings
WHERE label % 2 = 0 AND len(embedding) = 64""",
    "corpus_from_columns": """
SELECT doc_id AS id, CAST(length(text) AS INTEGER) AS n_content,
  CASE WHEN n_chars <= 2000 THEN source END AS source,
  CAST(coalesce(len(embedding), 0) AS INTEGER) AS dim
FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
    "vector_from_json": f"""
SELECT id, pos, {six('x', 'value')} FROM (
  SELECT vec_id AS id, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos,
    unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)""",
    "embed_hash_bow": f"""
SELECT doc_id, {BUCKET} AS bucket, count(*) AS n
FROM (SELECT doc_id, {WORDS.format(text='text')} AS w FROM documents) GROUP BY ALL""",
    "ingest_defaults": """
SELECT CASE WHEN lang <> 'en' THEN CAST(doc_id AS VARCHAR) ELSE sha256(text) END AS id,
  n_chars <= 1000 AS empty, CAST(length(text) AS INTEGER) AS n_content FROM documents""",
    "upsert": """
WITH batch AS (
  SELECT conv_id * 15 AS id, text AS content, role FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)
SELECT * FROM batch UNION ALL
SELECT doc_id, text, NULL FROM documents WHERE doc_id NOT IN (SELECT id FROM batch)""",
    "add_texts": f"""
WITH latest AS (
  SELECT conv_id AS id, text FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1),
merged AS (
  SELECT * FROM latest UNION ALL
  SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT id FROM latest)),
{bags('bag', 'documents', 'doc_id')}, {bags('new', 'merged', 'id')},
means AS (
  SELECT cid, list(m ORDER BY pos) AS e FROM (
    SELECT cid, pos, avg(x) AS m FROM (
      SELECT CAST(substr(source, 4) AS INTEGER) AS cid, unnest(range(64)) AS pos, unnest(e) AS x
      FROM bag JOIN documents ON id = doc_id) GROUP BY cid, pos)
  GROUP BY cid)
SELECT id, (SELECT cid FROM means m ORDER BY list_distance(m.e, new.e), cid LIMIT 1) AS cluster,
  CAST(length(text) AS INTEGER) AS n_content, list_sum(e) AS n_words
FROM new JOIN merged USING (id)""",
    "get_by_ids": """
SELECT event_id AS position, doc_id AS id, CAST(length(text) AS INTEGER) AS n_content
FROM events JOIN documents ON doc_id = user_id * 9""",
    "delete_by_ids": """
SELECT doc_id AS id, CAST(length(text) AS INTEGER) AS n_content FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "delete_by_filter": filtered("NOT coalesce(lang IN ('fr', 'de') AND n_chars < 1000, false)"),
    "filter_eq": filtered("lang = 'fr'"),
    "filter_op_eq": filtered("n_chars = 380"),
    "filter_ne": filtered("lang <> 'en' OR lang IS NULL"),
    "filter_in": filtered("source IN ('src1', 'src7', 'nowhere')"),
    "filter_nin": filtered("source NOT IN ('src1', 'src7', 'nowhere') OR source IS NULL"),
    "filter_and": filtered("(lang <> 'es' OR lang IS NULL) AND source IN ('src2', 'src3', 'src5') "
                           "AND n_chars > 500 AND n_chars <= 1500"),
    "filter_range": """
SELECT event_id FROM events WHERE try_cast(json_extract_string(props, '$.k') AS DOUBLE) >= 50""",
    "dist_cosine": to_mean("cosine"),
    "dist_dot": to_mean("dot"),
    "dist_euclidean": to_mean("euclidean"),
    "knn_single": f"""
WITH {VECTORS},
asked AS (
  SELECT list(m ORDER BY pos) AS e FROM (
    SELECT pos, avg(x) AS m FROM (SELECT unnest(range(len(e))) AS pos, unnest(e) AS x FROM vec)
    GROUP BY pos))
SELECT id, {six('d', 'distance')}, {six('1e0 - d', 'score')} FROM (
  SELECT id, {distance('cosine', 'vec.e', 'asked.e')} AS d FROM vec, asked)
ORDER BY d, id LIMIT 10""",
    "knn_join": label_search(10),
    "knn_in_place": f"WITH {VECTORS}, {TWENTIETH}" + "".join(
        f", {nearest(m, 'vec', 'asked', 10, m)}" for m in METRICS) + " UNION ALL ".join(
        f" SELECT '{m}' AS metric, query_id, id, rank, {six('distance')} FROM {m}" for m in METRICS),
    "ivf_calibrated": f"""
WITH {VECTORS}, {TWENTIETH}, {nearest('near', 'vec', 'asked', 10)}
SELECT query_id, id, rank, {six('distance')} FROM near""",
    "knn_dirty": dirty(),
    "knn_score": label_search(5, "dot", "1e0 - distance", "score"),
    "knn_filtered": label_search(5, "euclidean", where="c.label >= 3 AND c.label < 7"),
    "search_text": f"""
WITH {BAG_SEARCH}, {nearest('near', 'bag', 'asked', 4)}
SELECT query_id, id, rank, {six('distance')} FROM near""",
    "relevance_cosine": label_search(
        6, "cosine", "greatest(0e0, least(1e0, 1e0 - distance))", "relevance"),
    "relevance_euclidean": label_search(
        6, "euclidean", "1e0 / (1e0 + greatest(0e0, distance))", "relevance"),
    "relevance_dot": label_search(
        6, "dot", "greatest(0e0, least(1e0, (1e0 - distance) - 1e0))", "relevance"),
    "tokenize": f"SELECT DISTINCT doc_id, {WORDS.format(text='text')} AS token FROM documents",
    "postings": f"""
SELECT w AS term, id, CAST(count(*) AS INTEGER) AS tf
FROM (SELECT doc_id AS id, {TEXT_WORDS.format(text='text')} AS w FROM documents) GROUP BY w, id""",
    "keyword_overlap": f"""
WITH {OVERLAP}, {overlap('found', 10)} SELECT query_id, id, rank, score FROM found""",
    "keyword_tfidf": tfidf(10),
    "keyword_indexed": tfidf(10),
    "keyword_index_upkeep": tfidf(10, """
batch AS (
  SELECT conv_id * 15 AS doc_id, text FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1),
kept AS (
  SELECT * FROM (
    SELECT * FROM batch UNION ALL
    SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM batch))
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
""").replace("FROM documents) AS total", "FROM kept) AS total").replace(" AS w FROM documents)", " AS w FROM kept)"),
    "upsert_columns": """
WITH batch AS (
  SELECT conv_id * 15 AS id, text, role FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)
SELECT id, CAST(length(b.text) AS INTEGER) AS n_content, d.lang, role AS source, d.n_chars
FROM batch b LEFT JOIN documents d ON d.doc_id = id UNION ALL
SELECT doc_id, CAST(length(text) AS INTEGER), lang, source, n_chars FROM documents
WHERE doc_id NOT IN (SELECT id FROM batch)""",
    "embed_cached": f"""
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, n FROM (
SELECT doc_id, {BUCKET} AS bucket, count(*) AS n
FROM (SELECT doc_id, {WORDS.format(text='text')} AS w FROM documents) GROUP BY ALL)""",
    "stored_changes": """
WITH batch AS (
  SELECT doc_id AS id, 'new text of ' || doc_id AS content FROM labels
  WHERE toxic = 1 OR doc_id % 3 = 0),
kept AS (
  SELECT doc_id AS id, text AS content FROM documents
  WHERE doc_id NOT IN (SELECT id FROM batch)
    AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)
    AND NOT coalesce(n_chars >= 300 AND lang = 'fr', false))
SELECT id, CAST(length(content) AS INTEGER) AS n_content, md5(content) AS digest
FROM (SELECT * FROM batch UNION ALL SELECT * FROM kept)""",
    "stored_out_of_order": """
SELECT conv_id AS id, text AS content, '{"role":"' || role || '"}' AS metadata FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "rrf_fuse": f"""
WITH {BAG_SEARCH}, {nearest('a', 'bag', 'asked', 10)}, {nearest('b', 'bag', 'asked', 10, 'euclidean')},
{fuse('fused', 'a', 'b', 6, 0.7)} SELECT query_id, id, rank, {six('score')} FROM fused""",
    "hybrid_search": f"""
WITH {BAG_SEARCH}, {OVERLAP}, {nearest('a', 'bag', 'asked', 20)}, {overlap('b', 20)},
{fuse('fused', 'a', 'b', 4, 0.5)} SELECT query_id, id, rank, {six('score')} FROM fused""",
    "hybrid_filtered": f"""
WITH {BAG_SEARCH}, {OVERLAP}, {DOCS},
kept AS (SELECT id FROM docs WHERE lang <> 'en' OR lang IS NULL),
{nearest('a', 'bag', 'asked', 20, where='c.id IN (SELECT id FROM kept)')},
{overlap('b', 20, where='id IN (SELECT id FROM kept)')},
{fuse('fused', 'a', 'b', 4, 0.3)} SELECT query_id, id, rank, {six('score')} FROM fused""",
    "mmr_k2": diverse(2, 0.5),
    "mmr": diverse(4, 0.3),
    "mmr_text": diverse(2, 0.5, BAG_SEARCH, "bag"),
    "rag_context": f"""
WITH {BAG_SEARCH}, {nearest('near', 'bag', 'asked', 3)}
SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context
FROM near JOIN documents ON doc_id = id GROUP BY query_id""",
    "ivf_assign": f"WITH {VECTORS}, {LISTS} SELECT id, cluster FROM listed",
    "kmeans_step": f"""
WITH {VECTORS}, {LISTS}
SELECT label AS cid, CAST(pos AS INTEGER) AS pos, {six('coalesce(moved, old)', 'value')} FROM (
  SELECT label, unnest(range(len(e))) AS pos, unnest(e) AS old FROM means)
LEFT JOIN (
  SELECT cluster AS label, pos, avg(x) AS moved FROM (
    SELECT cluster, unnest(range(len(e))) AS pos, unnest(e) AS x FROM listed)
  GROUP BY cluster, pos) USING (label, pos)""",
    "kmeans_rounds": rounds(3),
    "ivf_train_sparse": label_search(5, where="c.label = 4"),
    "ivf_probe": f"""
WITH {VECTORS}, asked AS (SELECT id AS query_id, e FROM vec), {probes('asked', 3)}
SELECT query_id, place, cluster FROM probes""",
    "ivf_search": f"""
WITH {VECTORS}, {LABEL_QUERIES}, {LISTS}, {probes('asked', 2)}, {probed('near', 5)}
SELECT query_id, id, rank, {six('distance')} FROM near""",
    "ivf_incremental": f"""
WITH {VECTORS},
merged AS (
  SELECT id * 2 AS id, list_reverse(e) AS e FROM vec UNION ALL
  SELECT id, e FROM vec WHERE id NOT IN (SELECT id * 2 FROM vec))
SELECT id, (SELECT m.label FROM means m ORDER BY list_distance(m.e, x.e), m.label LIMIT 1) AS cluster
FROM merged x""",
    "ivf_build": label_search(10),
    "recall_at_k": f"""
WITH {VECTORS}, {LABEL_QUERIES}, {LISTS}, {probes('asked', 2)}, {probed('found', 10)},
{nearest('exact', 'vec', 'asked', 10)}
SELECT hits, total, {six('hits / total', 'recall')} FROM (
  SELECT count(found.id) AS hits, count(*) AS total
  FROM exact LEFT JOIN found ON found.query_id = exact.query_id AND found.id = exact.id)""",
    "ivf_scan_fraction": f"""
WITH {VECTORS}, asked AS (SELECT id AS query_id, e FROM vec), {LISTS}, {probes('asked', 2)},
sizes AS (SELECT cluster, count(*) AS n FROM listed GROUP BY cluster)
SELECT query_id, CAST(scanned AS BIGINT) AS scanned, total, {six('scanned / total', 'fraction')} FROM (
  SELECT query_id, coalesce(sum(n), 0) AS scanned, (SELECT count(*) FROM vec) AS total
  FROM probes LEFT JOIN sizes USING (cluster) GROUP BY query_id)""",
}
