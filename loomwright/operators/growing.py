"""What grows by batches: an index of codes that new ones meet, and components that new links contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from loomwright.operators import dedup
from loomwright.operators.relational import latest
from loomwright.session import settled
from loomwright.streaming.runs import Runs

#: Files that the values of one band are dealt to.
SLOTS = 16


class MetricIndex:
    """Codes (key, code) that are kept by their bands, so that a batch meets old codes within a radius without joining all again.

    A code is kept once for each band, in files by band and slot.  A batch reads only the
    files that its own bands name, finds the old codes that share a band's value, and meets
    these.  Null codes are not kept.  A key is added once.
    """

    def __init__(self, spark: SparkSession, path: str, radius: int, key_type=LongType()):
        self.spark, self.radius = spark, radius
        schema = StructType([StructField("key", key_type), StructField("code", LongType()), StructField("_piece", LongType()), StructField("_band", IntegerType()), StructField("_slot", IntegerType())])
        self.runs = Runs(spark, path, schema, by=["_band", "_slot"])

    def _banded(self, rows: DataFrame) -> DataFrame:
        pieces = F.element_at(F.transform(F.array(F.col("code")), lambda c: F.array(*dedup.bands_of(c, self.radius))), 1)
        spread = rows.filter("code is not null").select("key", "code", F.posexplode(pieces).alias("_band", "_piece"))
        return spread.withColumn("_slot", F.pmod(F.xxhash64("_piece"), F.lit(SLOTS)).cast("int"))

    def near(self, rows: DataFrame) -> DataFrame:
        """(key, code) of what is kept and shares a band's value with one of ``rows`` (key, code)."""
        asked = self._banded(rows).select("_band", "_slot", "_piece").distinct()
        files = [tuple(r) for r in asked.select("_band", "_slot").distinct().collect()]  # (radius + 1) * SLOTS at most
        place = F.col("_band") * SLOTS + F.col("_slot")
        found = self.runs.rows().filter(place.isin([b * SLOTS + s for b, s in files])) if files else self.runs.rows().limit(0)
        return found.join(asked, ["_band", "_slot", "_piece"], "left_semi").select("key", "code").distinct()

    def query(self, rows: DataFrame) -> DataFrame:
        """(key, other, distance) of the kept codes within the radius of each of ``rows`` (key, code)."""
        both = rows.select(F.struct(F.lit(True).alias("asked"), "key").alias("k"), "code").unionByName(self.near(rows).select(F.struct(F.lit(False).alias("asked"), "key").alias("k"), "code"))
        pairs = dedup.hamming_pairs(both.withColumn("asked", F.col("k.asked")), "k", "code", self.radius, ["asked"], new="asked")
        # Kept ones come first among structs; pairs of two that are asked for are of no use here.
        return pairs.filter(~F.col("left_asked")).select(F.col("right_k.key").alias("key"), F.col("left_k.key").alias("other"), "distance")

    def add(self, batch: DataFrame, number: int | None = None) -> DataFrame:
        """Keep a batch (key, code), and give the pairs (left_key, right_key, distance) that it brings: among itself, and with what was kept."""
        batch = settled(batch.select("key", "code"), "batch")
        done = self.runs.newest()
        if number is not None and number <= done:
            raise ValueError(f"batch {number} was added before")
        old = self.near(batch).join(batch, "key", "left_anti")
        both = batch.withColumn("new", F.lit(True)).unionByName(old.withColumn("new", F.lit(False)))
        pairs = settled(dedup.hamming_pairs(both, "key", "code", self.radius, ["new"], new="new").select("left_key", "right_key", "distance"), "pairs")
        self.runs.add(self._banded(batch).select("key", "code", "_piece", "_band", "_slot"), number)
        return pairs


class Components:
    """Labels (node, component) that links join by and by: a component is named by its least node.

    New links are first links between the old labels of their ends.  Only that small graph
    is searched, and only labels that move, and those of new nodes, are written.
    """

    def __init__(self, spark: SparkSession, path: str, node_type=LongType()):
        self.spark = spark
        schema = StructType([StructField("node", node_type), StructField("component", node_type), StructField("_at", IntegerType())])
        self.runs = Runs(spark, path, schema, lambda df: latest(df, "node", ["_at"]))

    def labels(self) -> DataFrame:
        return self.runs.table().select("node", "component")

    def add(self, links: DataFrame, left: str, right: str) -> DataFrame:
        """Join by links; the labels (node, component) that are new or moved."""
        links = settled(links.select(F.col(left).alias("u"), F.col(right).alias("v")).distinct(), "links")
        label, at = self.labels(), self.runs.newest() + 1
        ends = links.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(label, "node", "left")
        ends = settled(ends.select("node", F.coalesce("component", "node").alias("component"), F.col("component").isNull().alias("new")), "ends")
        name = lambda c: ends.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        small = links.join(name("u"), "u").join(name("v"), "v").filter("cu != cv").select("cu", "cv").distinct()
        moved = dedup.connected(small, "cu", "cv").filter("node != component").select(F.col("node").alias("component"), F.col("component").alias("to"))
        old = label.join(moved, "component").select("node", F.col("to").alias("component"))
        new = ends.filter("new").join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        changed = settled(old.unionByName(new).withColumn("_at", F.lit(at)), "moved")
        self.runs.add(changed, at)
        return changed.select("node", "component")
