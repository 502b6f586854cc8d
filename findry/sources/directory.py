"""Where each id of a corpus folder lies, and which places are gone.

``ids/bucket=<n>/`` holds one row for every row ever written: its id, its place (data file and row number) and the
order value it came with.  Ids are hashed into buckets of about ``IDS_PER_BUCKET``, sorted inside, so that finding the
old rows of a batch reads the buckets of its ids and no other part of the corpus.

``erased/`` holds the places that changes removed, as bitmaps: one 64-bit word for 64 rows of a file.  A place
is written once and never again, so a row that comes back lies elsewhere and the order of changes does not matter.
Readers send the words to the scan; no row is moved.  Beyond ``WORDS`` words the files are divided into groups, each
read with the words of its own files, so every broadcast is bounded whatever the number of removals.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.operators.topk import broadcast_if_small

CHANGE = "__change"
ORDER = "__order"
FILE, AT = "__file", "__at"
IDS_PER_BUCKET = 100_000
MOST_BUCKETS = 1 << 16
# Buckets that are named in the scan's filter; more are pruned by a join.
LITERAL_BUCKETS = 4096
# Bitmap words sent to one scan (about 100 bytes each), and files that are read by name.
WORDS = 500_000
NAMED_FILES = 2000
ORDER_TYPE = "decimal(38,9)"
ERASED = f"{FILE} string, word long, mask long, {CHANGE} string"


def order_value(column, kind: T.DataType):
    """An order column in the one type orders are kept in; numbers, dates and timestamps can be ordered."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    elif not isinstance(kind, (T.NumericType, T.NullType)):
        raise ValueError("rows are ordered by a number, a date or a timestamp")
    return column.cast(ORDER_TYPE)


def with_places(rows: DataFrame) -> DataFrame:
    """The rows of ``rows/`` as read, with the file and row number of each."""
    place = F.concat_ws("/", CHANGE, F.col("cluster").cast("string"), F.col("_metadata.file_name"))
    return rows.select("*", place.alias(FILE), F.col("_metadata.row_index").alias(AT))


def path_of(path: str, file: str) -> str:
    change, cluster, name = file.split("/")
    return f"{path}/rows/{CHANGE}={change}/cluster={cluster}/{name}"


def read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/rows").parquet(*[path_of(path, f) for f in files])


def _bucket(n: int):
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def _size(spark: SparkSession, path: str) -> int:
    return spark.read.schema("buckets int").parquet(f"{path}/directory").first()[0]


def create(spark: SparkSession, path: str, rows: int) -> None:
    """Fix the number of buckets for a new folder of so many rows."""
    n = min(MOST_BUCKETS, max(1, -(-rows // IDS_PER_BUCKET)))
    spark.createDataFrame([(n,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/directory")


def enter(spark: SparkSession, path: str, change: str, orders: DataFrame | None = None) -> None:
    """Enter the rows a change has just written; ``orders`` is ``id, __order``, null where absent."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows/{CHANGE}={change}")
    found = with_places(rows).select("id", FILE, AT)
    if orders is not None:
        found = found.join(orders.select("id", ORDER), "id", "left")
    else:
        found = found.withColumn(ORDER, F.lit(None).cast(ORDER_TYPE))
    n = _size(spark, path)
    found = found.withColumn("bucket", _bucket(n)).withColumn(CHANGE, F.lit(change))
    (found.repartition("bucket").sortWithinPartitions("bucket", "id")
     .write.partitionBy("bucket").mode("append").parquet(f"{path}/ids"))


def locate(spark: SparkSession, path: str, ids: DataFrame, changes, id_type: T.DataType) -> DataFrame:
    """``id, __file, __at, __order`` of every row that committed changes wrote for some distinct ids."""
    n = _size(spark, path)
    wanted = ids.select(F.col("id").cast(id_type).alias("id")).where("id is not null").withColumn("bucket", _bucket(n))
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField(FILE, T.StringType()), T.StructField(AT, T.LongType()),
        T.StructField(ORDER, T.DecimalType(38, 9)), T.StructField(CHANGE, T.StringType()),
        T.StructField("bucket", T.IntegerType())])
    try:
        entered = spark.read.schema(schema).parquet(f"{path}/ids")
    except AnalysisException as error:  # nothing was entered yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        entered = spark.createDataFrame([], schema)
    # No more literals than there are buckets.
    buckets = [r[0] for r in wanted.select("bucket").distinct().limit(LITERAL_BUCKETS + 1).collect()]
    if len(buckets) <= LITERAL_BUCKETS:
        entered = entered.where(F.col("bucket").isin(sorted(buckets)))
    return (entered.where(F.col(CHANGE).isin(sorted(changes)))
            .join(broadcast_if_small(wanted), ["bucket", "id"], "left_semi").select("id", FILE, AT, ORDER))


def erase(places: DataFrame, path: str, change: str) -> None:
    """Write ``__file, __at`` places as removed by a change."""
    bit = F.expr(f"shiftleft(1L, cast({AT} % 64 as int))")
    (places.groupBy(FILE, F.floor(F.col(AT) / 64).alias("word")).agg(F.bit_or(bit).alias("mask"))
     .withColumn(CHANGE, F.lit(change)).write.mode("append").parquet(f"{path}/erased"))


def without_erased(spark: SparkSession, path: str, rows: DataFrame, erased: DataFrame | None,
                   changes) -> DataFrame:
    """Rows of ``rows/`` that ``changes`` wrote, with their places, without the erased ones."""
    placed = with_places(rows)
    if erased is None:
        return placed
    total = erased.count()  # rows of the files' footers
    if not total:
        return placed
    if total <= WORDS:
        return _left(placed, erased)
    # One row for each file with removals, like the list of files that is read anyway.
    counts = sorted(erased.groupBy(FILE).count().collect())
    groups, size = [[]], 0
    for file, n in counts:
        if groups[-1] and size + n > WORDS:
            groups.append([])
            size = 0
        groups[-1].append(file)
        size += n
    known = {file for file, _ in counts}
    # A committed change erases places of committed rows only.
    parts = [_left(with_places(read_files(spark, path, group).select(*rows.columns)),
                   erased.where(F.col(FILE).isin(group))) for group in groups]
    whole = [f for f in map(key_of, rows.inputFiles()) if f not in known and f.split("/")[0] in changes]
    if whole:
        parts.append(with_places(read_files(spark, path, whole).select(*rows.columns)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def key_of(uri: str) -> str:
    change, cluster, name = uri.split("/")[-3:]
    return f"{change.split('=', 1)[1]}/{cluster.split('=', 1)[1]}/{name}"


def _left(placed: DataFrame, erased: DataFrame) -> DataFrame:
    words = erased.groupBy(F.col(FILE).alias("__f"), F.col("word").alias("__w")).agg(F.bit_or("mask").alias("__m"))
    gone = ((F.col(FILE) == F.col("__f")) & (F.floor(F.col(AT) / 64) == F.col("__w"))
            & (F.expr(f"getbit(__m, cast({AT} % 64 as int))") == 1))
    return placed.join(F.broadcast(words), gone, "left_anti")
