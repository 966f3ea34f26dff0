"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All but the last return the columns of
``documents``: doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import langid, minhash, packing, suffixes, tiling
from llm.common import Scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose vector is farther than this from every centroid is no text of a known language, nor is one
#: that is far for its number of distinct n-grams, which the model learns from its training texts.
MIN_SCORE = 0.05
#: Bytes of a passage that counts as repeated: no more than fifty words of running text have.
REPEATED_BYTES = 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language is set to the prediction; texts of no known language go."""
    docs = docs.select(*COLUMNS)
    seen = langid.reject(langid.annotate(docs, langid.fit(docs, floors=True)), MIN_SCORE)
    kept = seen.filter(F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id; of rows that repeat an id the least one."""
    copies = minhash.near_duplicates(docs, k=5, percent=80).filter("doc_id != component_id").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)
    again = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    # Only rows that repeat an id are aggregated; the least of them combines before its shuffle.
    least = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*")
    return kept.join(again, "doc_id", "left_anti").select(*COLUMNS).unionByName(least)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur elsewhere are cut out; documents without anything left go."""
    cut = suffixes.removed(docs, REPEATED_BYTES, with_text=True, carry=("lang", "source", "n_chars"))
    # A cut can fall inside a character; the rest of it goes too.
    left = F.when(F.col("n_removed") == 0, F.col("kept").cast("string")).otherwise(F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", ""))
    cut = cut.withColumn("text", left).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\s]"))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def drop_test_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = tiling.contained(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, with the ids."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_test_leaks),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
