"""Sums and numbers along a global order, and exact percentiles, without a task that sees all rows.

Rows are ranged over partitions by their order.  Each partition counts for itself; one
number of each partition gives all of them their offsets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loomwright.session import settled

_ROW_BITS = 33


def _with_offsets(placed: DataFrame, own: Column, columns: Sequence[str], local: Column, name: str) -> DataFrame:
    """``local`` plus what the partitions before hold; one row for each partition is sent to all tasks."""
    totals = {r["_p"]: r["n"] for r in placed.groupBy("_p").agg(own.alias("n")).collect()}
    parts = sorted(totals)
    before = np.concatenate([[0], np.cumsum([totals[p] for p in parts], dtype=np.int64)]).tolist()
    offsets = placed.sparkSession.createDataFrame(list(zip(parts, before)), "_p long, _before long")
    return placed.join(F.broadcast(offsets), "_p").select(*columns, (local + F.col("_before")).alias(name))


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, first: int = 1) -> DataFrame:
    """``df`` with the place of each row in ``order``."""
    placed = settled(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_p", F.shiftright("_m", _ROW_BITS)).withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    return _with_offsets(placed, F.count("*"), df.columns, F.col("_i") + first, name)


def running_sum(df: DataFrame, order: Sequence[Column | str], weight: Column, name: str) -> DataFrame:
    """``df`` with the sum of whole-number weights of all rows before each in ``order``."""
    rows = df.withColumn("_w", weight.cast("long"))
    schema = StructType([*rows.schema.fields, StructField("_p", LongType()), StructField("_s", LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            w = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = total + np.cumsum(w)
            columns = [*batch.columns, pa.array(np.full(len(w), part, np.int64)), pa.array(sums - w)]
            total = int(sums[-1]) if len(w) else total
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    placed = settled(rows.orderBy(*order).mapInArrow(add, schema), name)
    return _with_offsets(placed, F.sum("_w"), df.columns, F.col("_s"), name)


#: Distinct values that the driver takes at once, buckets of a bracket, and distinct values of a bracket that is not narrowed further.
AT_ONCE, BUCKETS, NARROW = 50_000, 4096, 1_000


def percentiles(df: DataFrame, wanted: dict[str, Sequence[float]], at_once: int = AT_ONCE, narrow: int = NARROW) -> DataFrame:
    """(field, point, value): exact percentiles, interpolated, of each field at its points (0 to 100).

    Nothing is sorted.  Equal values are counted first.  If these are many, each wanted place
    is bracketed: a bracket is cut into buckets between its least and greatest value, and the
    bucket that holds the place is the next bracket, until few values are left, among which
    the place is looked up.  A null value does not count, NaN counts as infinite, and a
    field without values has no rows.
    """
    spark = df.sparkSession
    number = F.col("f.value")
    fields = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("double").alias("value")) for n in wanted])
    counts = df.select(F.explode(fields).alias("f")).filter(number.isNotNull()).select("f.field", F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number).alias("value"))
    counts = counts.groupBy("field", "value").agg(F.count("*").alias("n"))
    some = counts.limit(at_once + 1).toArrow()
    if some.num_rows <= at_once:
        total = {r["field"]: r["n_sum"] for r in some.group_by("field").aggregate([("n", "sum")]).to_pylist()}
        inside = {(f, None): (0, some.filter(pc.equal(some["field"], f))) for f in total}
        place = {(f, k): (f, None) for f in total for k in _places(wanted[f], total[f])}
    else:
        total, inside, place = _bracketed(settled(counts, "counts"), wanted, narrow)
    value = {(f, k): _at(k, *inside[b]) for (f, k), b in place.items()}
    rows = []
    for f in total:
        for p in wanted[f]:
            at = p / 100 * (total[f] - 1)
            low, high, share = value[f, math.floor(at)], value[f, math.ceil(at)], at - math.floor(at)
            rows.append((f, float(p), low if low == high else (1 - share) * low + share * high))
    return spark.createDataFrame(rows, "field string, point double, value double")


def _places(points: Sequence[float], n: int) -> set[int]:
    return {k for p in points for k in (math.floor(p / 100 * (n - 1)), math.ceil(p / 100 * (n - 1)))}


def _at(k: int, before: int, values: pa.Table) -> float:
    """The value at a place, counted from the first value of all; ``before`` of them are less than these."""
    order = np.argsort(values["value"].to_numpy())
    ends = before + np.cumsum(values["n"].to_numpy()[order])
    return float(values["value"].to_numpy()[order[np.searchsorted(ends, k, "right")]])


def _bracketed(counts: DataFrame, wanted: dict[str, Sequence[float]], narrow: int) -> tuple[dict, dict, dict]:
    """(values of each field, {bracket: (values before it, its values)}, {(field, place): bracket})."""
    spark, v = counts.sparkSession, F.col("value")
    stats = counts.groupBy("field").agg(F.sum("n").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("rows")).collect()  # a row for each field
    total = {r.field: r.total for r in stats}
    bracket = {(r.field, k): (r.low, r.high, 0, r.rows) for r in stats for k in _places(wanted[r.field], r.total)}

    def sent(wide: list[tuple]) -> DataFrame:
        # A few for each wanted place.
        return F.broadcast(spark.createDataFrame([(f, float(a), float(b)) for f, a, b in wide], "field string, low double, high double"))

    while wide := sorted({(f, a, b) for (f, _), (a, b, _, n) in bracket.items() if n > narrow and a < b}):
        part = (v / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        which = F.when(v == F.col("low"), 0).when(v == F.col("high"), BUCKETS - 1).otherwise(F.floor(F.nanvl(part, F.lit(0.5)) * (BUCKETS - 1)))
        joined = counts.join(sent(wide), "field").filter((v >= F.col("low")) & (v <= F.col("high")))
        found = joined.groupBy("field", "low", "high", which.alias("bucket")).agg(F.sum("n").alias("n"), F.min("value").alias("a"), F.max("value").alias("b"), F.count("*").alias("rows"))
        cells: dict[tuple, list] = {}
        for r in found.collect():  # BUCKETS for each bracket at most
            cells.setdefault((r.field, r.low, r.high), []).append((r.a, r.b, r.n, r.rows))
        for (f, k), (a, b, before, n) in list(bracket.items()):
            for low, high, many, rows in sorted(cells.get((f, a, b), [])) if n > narrow else []:
                if k < before + many:
                    bracket[f, k] = (low, high, before, rows)
                    break
                before += many
    last = sorted({(f, a, b) for (f, _), (a, b, _, _) in bracket.items()})
    values = counts.join(sent(last), "field").filter((v >= F.col("low")) & (v <= F.col("high"))).select("field", "low", "high", "value", "n").toArrow()
    inside = {}
    for (f, _), (a, b, before, _) in bracket.items():
        if (f, a, b) not in inside:
            mine = pc.and_(pc.equal(values["field"], f), pc.and_(pc.equal(values["low"], float(a)), pc.equal(values["high"], float(b))))
            inside[f, a, b] = (before, values.filter(mine))
    return total, inside, {(f, k): (f, a, b) for (f, k), (a, b, _, _) in bracket.items()}
