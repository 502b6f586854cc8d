"""A Spark session with the settings these jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def settings(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings to pass to ``spark-submit --conf`` or a session builder."""
    out = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Wide rows (vectors, long texts): keep one Arrow batch well under a worker's memory.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    if shuffle_partitions:
        out["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return out


def local_session(cpus: int = 8, memory: str = "8g", name: str = "findry") -> SparkSession:
    """A single-machine session for tests and trials."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false"))
    for key, value in settings(cpus).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
