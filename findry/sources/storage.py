"""Corpora, indexes and postings as Parquet folders.

A corpus folder holds ``rows/__change=<name>/cluster=<n>/``, ``ids/`` and ``erased/`` (see
:mod:`findry.sources.directory`), ``changes/`` and, once an index is built, ``centroids/``; with a full-text index
also ``postings/`` and ``removed/`` (the ids taken out of them), written by the same changes.  Rows no list has been
chosen for lie in list ``-1``, which no search probes.

Nothing is ever overwritten.  A change appends its new rows, where their ids lie and the places of the rows it replaces
or deletes, each marked with a name of its own, and last of all a line in ``changes`` that gives the name its
place in the order.  Readers take the rows of committed changes only, without places a committed change
has erased; what a failed writer left behind is never seen, and running it again is safe.
One writer at a time.  :func:`compact` writes a corpus anew once removals have piled up.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findry.functions.text import term_bucket, text_words
from findry.operators import corpus as ops
from findry.operators import ivf
from findry.operators.ivf import Index
from findry.operators.topk import BROADCAST_ROWS, broadcast_if_small
from findry.schema import Columns, corpus_from_columns, corpus_schema
from findry.sources import directory
from findry.sources.directory import AT, CHANGE, FILE, ORDER
from findry.sources.lineage import fixed

UNASSIGNED = -1
CHANGE_SCHEMA = f"seq long, {CHANGE} string"
ROWS_PER_FILE = 100_000
# Documents whose postings of one folder are sorted together.
IDS_PER_SLOT = 25_000


def read_table(spark: SparkSession, path: str, columns: Columns = Columns(),
               format: str = "parquet") -> DataFrame:
    """An existing table in any Spark format under the standard column names."""
    return corpus_from_columns(spark.read.format(format).load(path), columns)


def spread(table: DataFrame, key: str) -> DataFrame:
    """Spread a table that is stored in fewer pieces than there are cores.

    For a table just read, ahead of costly work on each row.  A large table has more
    pieces than cores and is left as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table


def _read(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        # A table that was written without rows has no files.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _changes(spark: SparkSession, path: str) -> dict[str, int]:
    """Committed changes and their order; one entry per change since the folder was written."""
    found = _read(spark, f"{path}/changes", CHANGE_SCHEMA)
    return {} if found is None else {r[CHANGE]: r["seq"] for r in found.collect()}


def changes_of(spark: SparkSession, path: str) -> set[str]:
    """The committed changes of a corpus folder."""
    return set(_changes(spark, path))


def _commit(spark: SparkSession, path: str, change: str) -> None:
    seq = max(_changes(spark, path).values(), default=0) + 1
    (spark.createDataFrame([(seq, change)], CHANGE_SCHEMA).coalesce(1)
     .write.mode("append").parquet(f"{path}/changes"))


def read_rows(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame | None:
    """The rows of a corpus folder, or None if nothing was written yet.

    With ``ids``, a table of distinct ids, the rows of these only: the directory names the files that hold them.
    """
    changes = _changes(spark, path)
    rows = _placed(spark, path, changes)
    if rows is None:
        return None
    if ids is not None:
        found = directory.locate(spark, path, ids, changes, rows.schema["id"].dataType)
        files = [r[0] for r in found.select(FILE).distinct().limit(directory.NAMED_FILES + 1).collect()]
        if len(files) <= directory.NAMED_FILES:
            rows = _placed(spark, path, changes, files)
        rows = rows.join(broadcast_if_small(found.select(FILE, AT)), [FILE, AT], "left_semi")
    return rows.drop(FILE, AT)


def _placed(spark: SparkSession, path: str, changes: dict[str, int],
            files: list[str] | None = None) -> DataFrame | None:
    """The live rows with the place of each; of some files only if these are named."""
    rows = _read(spark, f"{path}/rows") if changes else None
    if rows is None:
        return None
    names = [c for c in rows.columns if c != CHANGE]
    erased = _read(spark, f"{path}/erased", directory.ERASED)
    if erased is not None:
        erased = erased.filter(F.col(CHANGE).isin(sorted(changes)))
    if files is not None:
        if files:
            rows = directory.read_files(spark, path, files).select(*rows.columns)
            erased = None if erased is None else erased.where(F.col(FILE).isin(files))
        else:
            rows = rows.limit(0)
            return rows.select(*names, F.lit("").alias(FILE), F.lit(0).cast("long").alias(AT))
    rows = rows.filter(F.col(CHANGE).isin(sorted(changes)))
    return directory.without_erased(spark, path, rows, erased, changes).select(*names, FILE, AT)


def _live_postings(spark: SparkSession, path: str, changes: dict[str, int]) -> DataFrame | None:
    """The postings that committed changes wrote and no later one removed."""
    rows = _read(spark, f"{path}/postings") if changes else None
    if rows is None:
        return None
    names = [c for c in rows.columns if c != CHANGE]
    rows = rows.filter(F.col(CHANGE).isin(sorted(changes)))
    removed = _read(spark, f"{path}/removed")
    if removed is not None:
        order = F.broadcast(spark.createDataFrame(
            [(n, c) for c, n in changes.items()], CHANGE_SCHEMA))
        gone = (removed.join(order, CHANGE).groupBy(F.col("id").alias("__id"))
                .agg(F.max("seq").alias("__gone")))
        # Removed ids are counted once by their files' footers, and few between compactions.
        gone = F.broadcast(gone) if removed.count() <= BROADCAST_ROWS else gone
        rows = rows.join(order, CHANGE).join(
            gone, (F.col("id") == F.col("__id")) & (F.col("__gone") > F.col("seq")), "left_anti")
    return rows.select(*names)


def read_centroids(spark: SparkSession, path: str) -> DataFrame | None:
    """Centroids in list order, or None if there is no index."""
    found = _read(spark, f"{path}/centroids", ivf.CENTROID_SCHEMA)
    if found is None or found.isEmpty():
        return None
    return found.orderBy("cid")


def current_folder(spark: SparkSession, path: str, first: str) -> tuple[int, str]:
    """Number and folder of the current version; ``first`` if none was committed."""
    found = _read(spark, f"{path}/versions", "version int, folder string")
    last = found.orderBy(F.desc("version")).first() if found is not None else None
    return (last["version"], last["folder"]) if last else (0, first)


def add_version(spark: SparkSession, path: str, version: int, folder: str) -> None:
    """Make a fully written folder the current version."""
    (spark.createDataFrame([(version, folder)], "version int, folder string").coalesce(1)
     .write.mode("append").parquet(f"{path}/versions"))


def read_index(spark: SparkSession, path: str, nprobe: int = ivf.DEFAULT_NPROBE) -> Index | None:
    centroids = read_centroids(spark, path)
    return None if centroids is None else Index(centroids, read_rows(spark, path), nprobe)


def _save(rows: DataFrame, path: str, rows_per_file: int, change: str,
          shares: DataFrame | None = None) -> int:
    """Append the rows of a change by list, a large list over as many tasks and files as it needs.

    Returns the number of rows.  ``shares`` of the lists only shape files, never which rows are written; without them
    the lists are counted.
    """
    total = rows.count()
    if shares is None:
        shares = rows.groupBy("cluster").agg((F.count("*") / F.lit(max(1, total))).alias("share"))
    slots = shares.select("cluster", F.greatest(
        F.lit(1), F.ceil(F.col("share") * total / rows_per_file)).alias("__slots"))
    slot = F.pmod(F.xxhash64("id"), F.coalesce("__slots", F.lit(1)))
    (rows.join(broadcast_if_small(slots), "cluster", "left").withColumn("__slot", slot)
     .repartition(max(1, -(-total // rows_per_file)), "cluster", "__slot")
     .drop("__slots", "__slot").withColumn(CHANGE, F.lit(change))
     .sortWithinPartitions("cluster", "id")
     .write.partitionBy(CHANGE, "cluster").mode("append")
     .option("maxRecordsPerFile", rows_per_file)
     # Lets a look-up by id skip the files that lack it.
     .option("parquet.bloom.filter.enabled#id", "true")
     .option("parquet.bloom.filter.expected.ndv#id", max(1, min(rows_per_file, total)))
     .parquet(f"{path}/rows"))
    return total


def _standard(rows: DataFrame) -> DataFrame:
    if "cluster" not in rows.columns:
        rows = rows.withColumn("cluster", F.lit(None).cast("int"))
    rows = rows.withColumn("cluster", F.coalesce(F.col("cluster").cast("int"), F.lit(UNASSIGNED)))
    first = [f.name for f in corpus_schema()]
    others = [c for c in rows.columns if c not in (*first, "cluster")]
    return rows.select(*first, *others, "cluster")


def _name() -> str:
    """A change's name, which no reader of a folder name takes for a number."""
    return f"c{uuid.uuid4().hex}"


def _write_new(spark, rows, path, rows_per_file, shares=None) -> None:
    if _changes(spark, path):
        raise ValueError(f"{path} holds a corpus already")
    change = _name()
    total = _save(_standard(rows), path, rows_per_file, change, shares)
    directory.create(spark, path, total)
    if total:
        directory.enter(spark, path, change)
    _commit(spark, path, change)


def write_rows(rows: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write a new corpus folder's rows, partitioned by list and sorted by id in each file."""
    _write_new(rows.sparkSession, rows, path, rows_per_file)


def write_index(index: Index, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write an index to a new folder: its centroids and its rows by list."""
    index.centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    _write_new(index.rows.sparkSession, index.rows, path, rows_per_file, index.shares)


def compact(spark: SparkSession, path: str, target: str,
            rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the live rows of a corpus folder, and its centroids, to a new folder."""
    centroids = read_centroids(spark, path)
    if centroids is not None:
        centroids.write.mode("overwrite").parquet(f"{target}/centroids")
    write_rows(read_rows(spark, path), target, rows_per_file)
    if has_fulltext(spark, path):
        ensure_fulltext(spark, target)


def upsert_rows(spark: SparkSession, path: str, batch: DataFrame,
                order_by: str | None = None) -> None:
    """Insert rows into a corpus folder or replace those with the same id.

    Rows are assigned to their nearest list if the folder has an index.  Only the batch is written,
    and the places of the rows it replaces, which the directory of ids gives.  Stored columns that the batch lacks
    keep the replaced row's values; columns that are not stored are refused.  Repeating a batch changes nothing.

    With ``order_by`` the row of the highest value wins, in the batch and across batches, whichever comes first;
    a row without a value loses to any with one.  The value is kept in the directory and not in the rows.
    """
    new = ops.latest(batch, order_by)
    if order_by is not None:
        value = directory.order_value(F.col(order_by), batch.schema[order_by].dataType)
        new = new.withColumn(ORDER, value).drop(order_by)
    rows = read_rows(spark, path)
    if rows is not None:
        unknown = sorted(set(new.columns) - set(rows.columns) - {"cluster", ORDER})
        if unknown:
            raise ValueError(f"the corpus has no columns {', '.join(unknown)}")
        held = [c for c in rows.columns if c not in new.columns and c != "cluster"]
        id_type = rows.schema["id"].dataType
        new = new.withColumn("id", F.col("id").cast(id_type))
    # Fixed before the corpus changes, so that every step sees the same rows.
    with fixed(new) as new:
        old = new.select("id").limit(0)
        if rows is not None:
            old = directory.locate(spark, path, new.select("id"), _changes(spark, path), id_type)
        with fixed(old) as old:
            if rows is not None and order_by is not None:
                last = old.groupBy("id").agg(F.max(ORDER).alias("__last"))
                new = new.join(last, "id", "left").where(
                    F.col("__last").isNull() | (F.col(ORDER) >= F.col("__last"))).drop("__last")
                old = old.join(new.select("id"), "id", "left_semi")
            orders = new.select("id", ORDER) if order_by is not None else None
            if rows is not None and held:
                kept = read_rows(spark, path, old.select("id").distinct()).select("id", *held)
                new = new.join(kept, "id", "left")
            new = new.drop(ORDER)
            # Fixed as well: a list may depend on what this change erases.
            with fixed(new) as new:
                centroids = read_centroids(spark, path)
                if centroids is not None:
                    new = ivf.assign(new, centroids)
                new = _standard(new)
                if rows is not None:
                    # Types follow the stored rows; vectors may be kept as floats to halve the table.
                    new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                       for f in rows.schema.fields])
                change = _name()
                _remove(old, path, change)
                total = _save(new, path, ROWS_PER_FILE, change)
                if rows is None:
                    directory.create(spark, path, total)
                if total:
                    directory.enter(spark, path, change, orders)
                if has_fulltext(spark, path):
                    _save_postings(new, path, change)
                _commit(spark, path, change)


def _remove(old: DataFrame, path: str, change: str) -> None:
    """Erase the places of ``id, __file, __at`` rows, and take the ids out of the postings if there are any."""
    if FILE not in old.columns or old.isEmpty():
        return
    directory.erase(old, path, change)
    if has_fulltext(old.sparkSession, path):
        old.select("id", F.lit(change).alias(CHANGE)).write.mode("append").parquet(f"{path}/removed")


def delete_rows(spark: SparkSession, path: str, ids: DataFrame) -> None:
    """Remove rows by id; the directory gives their places, and only these are written."""
    rows = read_rows(spark, path)
    if rows is None:
        return
    found = directory.locate(spark, path, ids.select("id").distinct(), _changes(spark, path),
                             rows.schema["id"].dataType)
    with fixed(found) as old:
        change = _name()
        _remove(old, path, change)
        _commit(spark, path, change)


def delete_matching(spark: SparkSession, path: str, filter, promoted_keys=None) -> None:
    """Remove the rows a filter matches; one without clauses removes none."""
    from findry.functions import filters

    rows = _placed(spark, path, _changes(spark, path))
    if rows is None or filters.predicate(filter) is None:
        return
    with fixed(filters.keep(rows, filter, promoted_keys=promoted_keys).select("id", FILE, AT)) as old:
        change = _name()
        _remove(old, path, change)
        _commit(spark, path, change)


def has_fulltext(spark: SparkSession, path: str) -> bool:
    """Whether a corpus folder has a full-text index, which every change then keeps up."""
    built = _read(spark, f"{path}/fulltext", f"{CHANGE} string")
    return built is not None and bool({r[CHANGE] for r in built.collect()} & changes_of(spark, path))


def ensure_fulltext(spark: SparkSession, path: str) -> None:
    """Build the postings of all rows of a corpus folder unless it has them."""
    rows = read_rows(spark, path)
    if rows is None or has_fulltext(spark, path):
        return
    change = _name()
    _save_postings(rows, path, change)
    (spark.createDataFrame([(change,)], f"{CHANGE} string").coalesce(1)
     .write.mode("append").parquet(f"{path}/fulltext"))
    _commit(spark, path, change)


def read_fulltext(spark: SparkSession, path: str) -> DataFrame | None:
    """The postings of the live rows of a corpus folder, or None if it has no full-text index."""
    if not has_fulltext(spark, path):
        return None
    return _live_postings(spark, path, _changes(spark, path))


def _save_postings(rows: DataFrame, path: str, change: str) -> None:
    """Append the postings of rows: their words are shuffled once, by folder and by a part of the ids.

    A common word's postings so lie in several files, and counting a document's repeats needs no shuffle of its own.
    """
    slots = max(1, -(-rows.count() // IDS_PER_SLOT))
    # A written corpus may lie in fewer files than there are cores.
    words = spread(rows.select("id", "content"), "id").select(
        "id", F.explode(text_words(F.col("content"))).alias("term"))
    (words.withColumn("bucket", term_bucket(F.col("term")))
     .withColumn("__slot", F.pmod(F.xxhash64("id"), F.lit(slots)))
     .repartition("bucket", "__slot")
     .groupBy("bucket", "__slot", "term", "id").agg(F.count("*").cast("int").alias("tf"))
     .select("term", "id", "tf", F.lit(change).alias(CHANGE), "bucket")
     .sortWithinPartitions("bucket", "term", "id")
     .write.partitionBy("bucket").mode("append").parquet(f"{path}/postings"))


def write_postings(postings: DataFrame, path: str, files: int | None = None,
                   mode: str = "errorifexists") -> None:
    """Write a postings table so that a search for few words reads few files.

    Words are hashed into folders and sorted inside; splitting by (word, id) ranges gives
    the most common words several files each.
    """
    bucketed = postings.withColumn("bucket", term_bucket(F.col("term")))
    order = ["bucket", "term", "id"]
    parts = [files] if files else []
    (bucketed.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
     .write.partitionBy("bucket").mode(mode).parquet(path))


def ensure_postings(corpus: DataFrame, path: str) -> DataFrame:
    """The postings table of a corpus, built on the first call and only read after that."""
    from findry.operators import keyword

    spark = corpus.sparkSession
    found = read_postings(spark, path)
    if found is None:
        write_postings(keyword.postings(corpus), path)
        found = read_postings(spark, path)
    return found


def read_postings(spark: SparkSession, path: str) -> DataFrame | None:
    return _read(spark, path)
