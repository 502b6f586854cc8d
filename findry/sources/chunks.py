"""A table cut into files that every task of a scan reads one after another.

For a search whose query side is too large to broadcast: the queries are written once, as files of bounded
size in the folder all executors share, and the large table is scanned in place.  Each task holds a bounded
part of its own rows and streams the query files over it.  The large table is read once and never shuffled,
however many queries there are; a task's memory holds its part of the rows and one file.

Where the shared folder lies on a file system that only Spark reads, the files are fetched and broadcast one
after another instead, and the table is scanned once for each (:meth:`Chunks.scan`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from findry.functions import kernels
from findry.sources.lineage import shared_folder

# Bytes of its own rows a task holds while it reads the files.
HELD_BYTES = 64 << 20


def _place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _readable(uri: str) -> bool:
    try:
        files, path = _place(uri)
        return files.get_file_info(path).type == pyarrow.fs.FileType.File
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


@dataclass
class Chunks:
    """Files of a table; with ``key``, the lowest and highest value of that column in each."""

    spark: SparkSession
    files: list[tuple]  # (uri, low, high), ordered
    schema: pa.Schema
    key: str | None = None

    def read(self, uri: str) -> pa.Table:
        files, path = _place(uri)
        return pyarrow.parquet.read_table(path, filesystem=files, partitioning=None).select(
            self.schema.names).cast(self.schema)

    def scan(self, table: DataFrame, needed: str, start: Callable, schema,
             held_bytes: int = HELD_BYTES) -> DataFrame:
        """Scan ``table`` in place; every held part of a task's rows meets every file once.

        ``start(held)`` returns a function that is called with one file after another, as Arrow tables, and
        returns a record batch of ``schema`` or None.  Rows without a sound ``needed`` are left out.  With
        ``key``, files whose range holds no value of the held rows are not opened.
        """
        if not self.files:
            return table.limit(0).mapInArrow(lambda batches: iter(()), schema)
        given = self._given()
        if given is not None:
            return self._pass(table, needed, start, schema, held_bytes, given)
        parts = []
        for uri, low, high in self.files:
            one = self.spark.read.parquet(uri).toArrow().select(self.schema.names).cast(self.schema)
            sent = self.spark.sparkContext.broadcast(one)
            parts.append(self._pass(table, needed, start, schema, held_bytes,
                                    [(low, high, lambda sent=sent: sent.value)]))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def _given(self):
        """What a task needs to open the files itself; None where only Spark reads them."""
        if not _readable(self.files[0][0]):
            return None
        plain = Chunks(None, self.files, self.schema, self.key)
        return [(low, high, lambda uri=uri: plain.read(uri)) for uri, low, high in self.files]

    def _pass(self, table, needed, start, schema, held_bytes, given) -> DataFrame:
        key = self.key

        def run(batches):
            held, size = [], 0

            def met():
                rows = pa.Table.from_batches(held)
                keys = None if key is None else pc.unique(rows.column(key)).drop_null()
                score = start(rows)
                for low, high, read in given:
                    if keys is not None and not pc.any(pc.and_(
                            pc.greater_equal(keys, low), pc.less_equal(keys, high))).as_py():
                        continue
                    out = score(read())
                    if out is not None and out.num_rows:
                        yield out

            for batch in batches:
                batch = batch.filter(pa.array(kernels.sound(batch.column(needed))))
                if batch.num_rows:
                    held.append(batch)
                    size += batch.nbytes
                if size >= held_bytes:
                    yield from met()
                    held, size = [], 0
            if held:
                yield from met()

        return table.mapInArrow(run, schema)


def cut_into_chunks(frame: DataFrame, rows: int, per_chunk: int, key: str | None = None,
                    order: str | None = None) -> Chunks:
    """Write ``frame`` of ``rows`` rows as files of about ``per_chunk`` rows, by ranges of ``key`` if given.

    A frequent key is divided by ``order``.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/chunks-{uuid.uuid4().hex}"
    n = max(1, -(-rows // max(1, per_chunk)))
    if key:
        frame = frame.repartitionByRange(n, key, order).sortWithinPartitions(key, order)
    else:
        frame = frame.repartition(n)
    frame.write.option("maxRecordsPerFile", 2 * max(1, per_chunk)).parquet(path)
    schema = to_arrow_schema(frame.schema)
    if key:
        written = spark.read.schema(frame.schema).parquet(path)
        found = (written.groupBy(F.col("_metadata.file_path").alias("file"))
                 .agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("low", "high", "file").collect())
        return Chunks(spark, [tuple(r) for r in found], schema, key)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    names = sorted(s.getPath().toString() for s in listed if s.getPath().getName().startswith("part-"))
    return Chunks(spark, [(name, None, None) for name in names], schema)
