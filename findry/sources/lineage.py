"""Cutting long or costly lineage on reliable storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, which all executors share.

    A folder of our own is set only on a local master that names none.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _write(frame: DataFrame) -> tuple[str, DataFrame]:
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/fixed-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return path, spark.read.schema(frame.schema).parquet(path)


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    A written table, unlike a checkpoint, computes the frame only once.  It stays until the
    folder is cleared; where its use ends with a block, :func:`fixed` removes it.
    """
    return _write(frame)[1]


@contextmanager
def fixed(frame: DataFrame) -> Iterator[DataFrame]:
    """A written copy of a frame that is deleted at the end of the block."""
    path, table = _write(frame)
    try:
        yield table
    finally:
        remove(frame.sparkSession, path)
