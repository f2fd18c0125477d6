"""Where a plan's lineage is cut: a table in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows may have some megabytes. Left alone, the writer looks at a page's size after a hundred rows first, and a page is held, compressed and read as a whole,
#: outside the heap too. Row groups are held until they are full.
PAGES = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "16", "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "16", "parquet.block.size": str(16 << 20)}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names. Without one a session on this machine alone gets a temporary folder; a cluster's is an error."""
    named = spark.conf.get(KEY, None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{KEY} must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="cairnwork-")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set(KEY, named)
    return named.rstrip("/")


def bounded_batches(df: DataFrame, most: int = 8 << 20) -> DataFrame:
    """df, after its session's Arrow batches are held to `most` bytes: batches of whole texts then stay small on both sides of Python."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key).lower().rstrip("b")
    if not now.lstrip("-").isdigit() or int(now) <= 0 or int(now) > most:
        conf.set(key, str(most))
    return df


def apart(spark: SparkSession, n: int) -> list[int]:
    """n ints that repartition(n, column of ints) deals to n partitions. Of 0 to n - 1 about a third of the partitions would get none, and others several, one after the other."""
    found: dict[int, int] = {}
    at, step = 0, 16 * n + 64
    while len(found) < n:
        for r in spark.range(at, at + step).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p")).collect():
            found.setdefault(r["p"], r["id"])
        at += step
    return [found[p] for p in range(n)]


def local_table(spark: SparkSession, columns: dict[str, pa.DataType], rows: list[tuple]) -> DataFrame:
    """A few rows of the driver's. Of a list Spark would make a Python RDD, for which each executor starts Python processes beside the others, and they stay."""
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(columns.values())], names=list(columns)))


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: the cluster's own cleaning applies
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there is removed when the application ends."""
    path = f"{shared_dir(spark)}/cairnwork/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def cut(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write df to the shared folder and read it again, so that a lost executor costs one read, not the whole plan.

    The table is removed when the application ends. Null-typed columns are not supported. release: the shuffle files behind df go once it is written,
    else they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, str(release or before == "true").lower())
    try:
        df.write.options(**PAGES).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, table: str, path: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except Exception:  # the session has ended
        return
    _remove(spark, path)


def cut_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like cut, as a table bucketed by a column: joins on that column do not shuffle it. The table is dropped when the application ends."""
    spark, table = df.sparkSession, f"cairnwork_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/cairnwork/{table}"
    df.write.options(**PAGES).option("path", path).bucketBy(buckets, column).format("parquet").saveAsTable(table)
    atexit.register(_drop, spark, table, path)
    return spark.table(table)
