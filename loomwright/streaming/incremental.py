"""Incremental runs: only files that are new since the last run, merged into keyed state."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loomwright.operators import relational
from loomwright.session import file_at, shared_folder
from loomwright.streaming.runs import Runs, bucket

#: Files of a run that keys are dealt to: a few keys are looked up in a few of them.
BUCKETS = 16


class KeyedState:
    """The latest row of each key, in runs: a batch writes its own rows, and a repeated batch nothing."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, order: Sequence[str]):
        self.key, self.names = key, schema.fieldNames()
        whole = StructType([*schema.fields, StructField("_bucket", IntegerType())])
        self.runs = Runs(spark, path, whole, lambda df: relational.latest(df, key, list(order)), ["_bucket"])

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.names, bucket(F.col(self.key), BUCKETS).alias("_bucket"))

    def version(self, number: int | None = None) -> DataFrame:
        return self.runs.table(number).select(*self.names)

    def merge(self, batch: DataFrame, number: int | None = None) -> int:
        return self.runs.add(self._dealt(batch), number)

    def of(self, keys: DataFrame) -> DataFrame:
        """Rows of the keys in a table of them; only their files are read."""
        wanted = keys.select(self.key).distinct()
        files = [r[0] for r in wanted.select(bucket(F.col(self.key), BUCKETS)).distinct().collect()]  # BUCKETS at most
        rows = self.runs.rows().filter(F.col("_bucket").isin(files)).join(wanted, self.key, "left_semi")
        return self.runs.merge(rows).select(*self.names)


def latest_by_stream(spark: SparkSession, source: str, key: str, order: Sequence[str], folder: str | None = None, files_per_batch: int = 4) -> DataFrame:
    """Read what is new in ``source``, merge it batch by batch, and give the latest row of each key.

    With the same ``folder`` a later run goes on where this one ended.
    """
    folder = folder or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(source).schema
    state = KeyedState(spark, f"{folder}/state", schema, key, order)

    def merge(batch: DataFrame, number: int) -> None:
        state.merge(batch, number)

    place, _, name = source.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format("parquet")
    stream = reader.load(source) if _is_folder(spark, source) else reader.option("pathGlobFilter", name).load(place)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return state.version()


def _is_folder(spark: SparkSession, path: str) -> bool:
    where, files = file_at(spark, path)
    return files.getFileStatus(where).isDirectory()


def hourly_by_stream(spark: SparkSession, source: str, folder: str | None = None, late: str = "30 days", files_per_batch: int = 4) -> tuple[DataFrame, int]:
    """((hour_start, event_type, n, total), late rows) of events (ts, event_type, value) that come in files, in whatever order.

    An event is late if its hour ended more than ``late`` before the newest event of the
    batches up to the last but one before its own, which is when Spark's watermark has
    taken effect; it is left out and counted.  Spark keeps the sums of open hours
    in its state store, which outlives executors, and each batch writes the hours that it
    changed.  With the same ``folder`` a later run goes on where this one ended.
    """
    folder = folder or f"{shared_folder(spark)}/hours-{uuid.uuid4().hex}"
    schema = spark.read.parquet(source).schema
    hours = StructType.fromDDL("hour_key string, hour_start long, event_type string, n long, total double, batch long")
    state = KeyedState(spark, f"{folder}/hours", hours, "hour_key", ["batch"])
    place, _, name = source.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format("parquet")
    stream = reader.load(source) if _is_folder(spark, source) else reader.option("pathGlobFilter", name).load(place)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp")).filter("ts is not null").withWatermark("ts", late)
    grouped = stream.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    start = F.unix_timestamp("w.start")

    def merge(batch: DataFrame, number: int) -> None:
        key = F.concat_ws("|", start.cast("string"), F.coalesce(F.concat(F.lit("="), "event_type"), F.lit("null")))
        state.merge(batch.select(key.alias("hour_key"), start.alias("hour_start"), "event_type", "n", "total", F.lit(number).cast("long").alias("batch")), number)

    grouped.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    found = state.version().select("hour_start", "event_type", "n", "total")
    read = spark.read.schema(schema).parquet(source).filter("ts is not null").count()
    return found, read - (found.agg(F.sum("n")).first()[0] or 0)
