"""Joins, upserts, grouping and audits on keyed relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; the filter on the rank lets Spark cut groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Union in which the new rows win, and of those the last by ``order``."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return first_wins(both, [key], [F.desc("_new"), F.desc(order)]).drop("_new")


def latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key as an aggregate that combines before its shuffle."""
    rest = F.struct(*[c for c in df.columns if c != key])
    return df.groupBy(key).agg(F.max_by(rest, F.struct(*order)).alias("_row")).select(key, "_row.*")


def pending(sources: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that are not done yet."""
    return sources.join(done.select(key).distinct(), key, "left_anti")


def present(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return rows.join(other.select(key).distinct(), key, "left_semi")


def with_fallback(rows: DataFrame, key: str, column: str, first: DataFrame, second: DataFrame, default: Column) -> DataFrame:
    """``column`` from the first lookup that has it."""
    a, b = first.select(key, F.col(column).alias("_a")), second.select(key, F.col(column).alias("_b"))
    return rows.join(a, key, "left").join(b, key, "left").withColumn(column, F.coalesce("_a", "_b", default)).drop("_a", "_b")


def merge_scores(rows: DataFrame, scores: DataFrame, key: str, order: str) -> DataFrame:
    """rows with the last score of each key, whose columns win over the rows' own."""
    best = first_wins(scores, [key], [F.desc(order)]).drop(order)
    mine = rows.select(*[c for c in rows.columns if c == key or c not in best.columns])
    return mine.join(best, key)


def missing(rows: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Rows without a score, which a caller may refuse."""
    return rows.join(scores, key, "left_anti")


def conflicts(mapping: DataFrame, name: str, source: str) -> DataFrame:
    """Names that stand for more than one source."""
    return mapping.groupBy(name).agg(F.count_distinct(source).alias("sources")).filter("sources > 1")


def set_audit(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with what is wrong: ``missing``, ``unexpected`` or ``repeated``."""
    a = expected.select(*keys).distinct().withColumn("_expected", F.lit(True))
    b = actual.groupBy(*keys).agg(F.count("*").alias("_n"))
    both = a.join(b, list(keys), "full")
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_expected").isNull(), "unexpected").when(F.col("_n") > 1, "repeated")
    return both.select(*keys, problem.alias("problem")).filter("problem is not null")


def status_counts(states: DataFrame, status: str = "status") -> DataFrame:
    return states.groupBy(status).agg(F.count("*").alias("n"))


def consolidated(selection: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Each selected row with its state, pending where there is none."""
    return selection.join(states, key, "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def complete(df: DataFrame, key: str, tasks: Column, done: Column, failed: Column) -> DataFrame:
    """Whether all tasks of a key are done and none failed; a key without tasks is not complete."""
    out = df.groupBy(key).agg(F.sum(tasks.cast("long")).alias("tasks"), F.sum(done.cast("long")).alias("done"), F.sum(failed.cast("long")).alias("failed"))
    return out.withColumn("complete", (F.col("failed") == 0) & (F.col("tasks") == F.col("done")) & (F.col("done") > 0))


def reuse(tasks: DataFrame, previous: DataFrame, keys: Sequence[str], order: str, least: str = "min_scale") -> DataFrame:
    """Tasks with the last earlier output that is large enough, if any."""
    last = first_wins(previous, list(keys), [F.desc(order)]).select(*keys, F.col("scale").alias("old_scale"))
    return tasks.join(last, list(keys), "left").withColumn("reused", F.coalesce(F.col("old_scale") >= F.col(least), F.lit(False)))


def ordered_distinct(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys in the order of their first occurrence, with its position."""
    return df.groupBy(key).agg(F.min(position).alias(position)).orderBy(position)
