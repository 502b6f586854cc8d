"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a local master without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="findry-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``new_path`` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables of one job: written once, read back, dropped when no longer needed.

    A written table survives the loss of executors and cuts the lineage, so nothing before it is
    computed twice.  What a returned DataFrame still reads stays until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, frame: DataFrame, label: str) -> DataFrame:
        path = new_path(self.spark, f"{self.name}-{label}")
        frame.write.option("compression", "zstd").parquet(path)
        old = self.paths.get(label)
        self.paths[label] = path
        if old:
            remove(self.spark, old)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self.paths.pop(label, None)
            if path:
                remove(self.spark, path)
