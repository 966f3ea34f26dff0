"""Tables, scratch storage and sizes shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting by which a finished write removes its shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of an Arrow batch where the session does not say: texts may be long, and several tasks share an executor.
BATCH, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def ship(spark: SparkSession) -> None:
    """Send this subpackage to the executors, which need not have the repository, and bound Arrow batches."""
    import os
    import zipfile

    if spark.conf.get(BATCH, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH, BATCH_BYTES)
    context = spark.sparkContext
    if any(f.rpartition("/")[2] == "llm_operators.zip" for f in context._jsc.sc().listFiles().mkString("\n").splitlines()):
        return
    here, path = os.path.dirname(os.path.abspath(__file__)), os.path.join(tempfile.mkdtemp(), "llm_operators.zip")
    with zipfile.ZipFile(path, "w") as out:
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                out.write(os.path.join(here, name), f"llm/{name}")
    context.addPyFile(path)


def release() -> None:
    """Give memory that is free in this worker back to the machine: workers outlive tasks, and executors count it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches, with what it leaves free released at the end of its task."""

    def tidy(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return tidy


def done(result):
    """``result`` of a group, after a release."""
    release()
    return result


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; one of our own only where that is unset and all run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='scratch-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/llm"


class Scratch:
    """Tables written to shared storage, which cut lineage and outlive executors."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark, self.root = spark, f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.remove)

    def put(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df`` and read it back; what it shuffled is removed once it is written."""
        path, schema, conf = f"{self.root}/{name}", df.schema, self.spark.conf
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            writer = df.write.option("compression", "zstd")
            (writer.partitionBy(by) if by else writer).parquet(path)
        finally:
            conf.set(CLEANUP, before)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def remove(self) -> None:
        """All of it, when the program ends: results may be read until then."""
        try:
            self.drop("")
        except Exception:  # the session's machinery may be gone already
            pass

    def tidy(self) -> None:
        """Let Spark's cleaner remove shuffle files of finished steps."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))

