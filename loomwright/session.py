"""Sessions with the settings that the engine counts on, and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Rows of a task of ``in_tasks``.
TASK_ROWS = 500_000

_HADOOP: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt to all cores by a key: a small table is one task, however much work each of its rows is."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, key)


def in_tasks(rows: DataFrame, key: str, count: int) -> DataFrame:
    """``rows`` dealt by a key to tasks of about ``TASK_ROWS`` of ``count`` rows: what one task sorts or groups does not grow with the table.

    Without a number Spark joins partitions until they are 64 MB as they are stored, which in memory are thirty times that for rows of few values.
    """
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // TASK_ROWS)), key)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where all run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def settled(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and its rows stay as they are."""
    spark = df.sparkSession
    path, schema = f"{shared_folder(spark)}/core/{name}-{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    atexit.register(_remove, spark, path)  # results may be read until the program ends
    return spark.read.schema(schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where, files = file_at(spark, path)
        files.delete(where, True)
    except Exception:  # the session's machinery may be gone already
        pass


def file_at(spark: SparkSession, path: str):
    """(path, file system) by which Spark reaches it."""
    context = spark.sparkContext
    if context not in _HADOOP:  # finding a class by its name takes many calls
        _HADOOP[context] = context._jvm.org.apache.hadoop.fs.Path, context._jsc.hadoopConfiguration()
    make, conf = _HADOOP[context]
    where = make(path)
    return where, where.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    where, files = file_at(spark, path)
    return files.exists(where)
