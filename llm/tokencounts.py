"""Token counts: additive totals by source, language and tokenizer version.

Changes are signed: an insert adds a document's count, a delete takes it away, a revised
count takes the old one away and adds the new one.  A batch of changes is aggregated to
one delta for each (source, language, tokenizer) and committed under its batch number;
committing a number again replaces its delta, so a repeated batch counts once.  The
totals are the sum of all deltas; compacting folds deltas into one.  A tokenizer version is
a pattern that the engine counts by itself, or a public vocabulary.

Null sources and languages are groups of their own.  A null count is 0 tokens.  Groups
whose totals are all 0 are left out.  An empty batch commits an empty delta.  Rows that
repeat an id count once each.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from llm.common import Scratch, table, tidied

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"
#: Tokenizer versions that SQL can count: runs without white space, and runs of letters, runs of digits or single other signs.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]"}


def tokens(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


class Rollup:
    """A table of deltas.  A batch has a folder, and in it one for each attempt to commit it.

    The last attempt that was written whole counts, so a commit takes effect at once or not
    at all, and committing again replaces it.  A compacted base holds all batches up to one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _list(self, path: str) -> list[str]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(n.removeprefix(f"{kind}=")) for n in self._list(self.path) if n.startswith(f"{kind}="))

    def _attempts(self, folder: str, whole: bool) -> list[int]:
        found = [n for n in self._list(f"{self.path}/{folder}") if n.startswith("attempt=")]
        return sorted(int(n.removeprefix("attempt=")) for n in found if not whole or "_SUCCESS" in self._list(f"{self.path}/{folder}/{n}"))

    def _write(self, delta: DataFrame, folder: str) -> None:
        n = max(self._attempts(folder, False), default=0) + 1
        # A delta has a row for each source, language and tokenizer, however many changes it sums.
        delta.filter("d_docs != 0 or d_tokens != 0").coalesce(1).write.parquet(f"{self.path}/{folder}/attempt={n}")

    def _base(self) -> int | None:
        return max((b for b in self._numbers("base") if self._attempts(f"base={b}", True)), default=None)

    def commit(self, batch: int, changes: DataFrame) -> None:
        """changes: source, lang, tokenizer, sign (1 or -1), n_tokens.  A batch that was compacted cannot change any more."""
        base = self._base()
        if base is not None and batch <= base:
            raise ValueError(f"batch {batch} is compacted")
        sign = F.coalesce(F.col("sign"), F.lit(0)).cast("long")
        delta = changes.groupBy(*[F.col(k).cast("string").alias(k) for k in KEYS]).agg(F.sum(sign).alias("d_docs"), F.sum(sign * F.coalesce(F.col("n_tokens"), F.lit(0))).alias("d_tokens"))
        self._write(delta, f"batch={int(batch)}")

    def _paths(self, upto: int | None = None) -> list[str]:
        base = self._base()
        folders = [f"base={base}"] if base is not None else []
        folders += [f"batch={b}" for b in self._numbers("batch") if (base is None or b > base) and (upto is None or b <= upto)]
        return [f"{self.path}/{f}/attempt={self._attempts(f, True)[-1]}" for f in folders if self._attempts(f, True)]

    def deltas(self, upto: int | None = None) -> DataFrame:
        paths = self._paths(upto)
        return self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)

    def compact(self, upto: int) -> None:
        """Fold all batches up to one into a base; those that read meanwhile see the batches or the base, never both."""
        self._write(self.deltas(upto).groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens")), f"base={int(upto)}")

    def totals(self) -> DataFrame:
        return self.deltas().groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).filter("n_docs != 0 or n_tokens != 0")


def vocabulary_counts(docs: DataFrame, version: str, tokenizer_path: str) -> DataFrame:
    """docs (text, ...) with the number of ids that a public tokenizer's vocabulary gives each text, in a column named ``version``."""
    from llm.packing import TEXT_BYTES, _encoder
    from llm.textcodes import byte_chunks

    text = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField(version, LongType())])

    def count(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(tokenizer_path, 0)
        for batch in batches:
            sizes = [np.diff(encoder.encode_texts(data, offsets)[1]) - 1 for _, data, offsets in byte_chunks(batch.column(text), TEXT_BYTES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]), pa.int64())], schema.names)

    return docs.mapInArrow(tidied(count), schema)


def inserts(counts: DataFrame, version: str, sign: int = 1) -> DataFrame:
    """Changes from a table with a count column for each version; ``n``, if there is one, is how many documents a row stands for."""
    times = F.col("n") * sign if "n" in counts.columns else F.lit(sign)
    return counts.select("source", "lang", F.lit(version).alias("tokenizer"), times.alias("sign"), F.col(version).alias("n_tokens"))


def firsts(counts: DataFrame) -> DataFrame:
    """(source, lang, counts, n) of the rows with the least id of each text, as aggregates that combine before their shuffles: no join meets a frequent text."""
    same = counts.groupBy("digest", "doc_id", "source", "lang", *VERSIONS).agg(F.count("*").alias("n"))
    # Rows of one text and id differ in source and language only.
    of_id = same.groupBy("digest", "doc_id").agg(F.collect_list(F.struct("source", "lang", *VERSIONS, "n")).alias("rows"))
    return of_id.groupBy("digest").agg(F.min_by("rows", "doc_id").alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, digest of the text and a count for each version."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.sha2(text, 256).alias("digest"), *[tokens(text, v).alias(v) for v in VERSIONS])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 inserts all documents, 2 deletes later copies of a text, 3 revises what is left to the next version; 2 comes twice."""
    scratch = Scratch(spark, "tokencounts")
    counts = scratch.put(counted(table(spark, sf_dir, "documents")), "counts")
    named = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    first = scratch.put(firsts(counts.filter(named)), "firsts")
    rollup = Rollup(spark, f"{scratch.root}/deltas")
    rollup.commit(1, inserts(counts, "words-1"))
    for _ in range(2):  # all, but for the first ones
        rollup.commit(2, inserts(counts.filter(named), "words-1", -1).unionByName(inserts(first, "words-1")))
    kept = counts.filter(~named).select("source", "lang", *VERSIONS).withColumn("n", F.lit(1).cast("long")).unionByName(first)
    rollup.commit(3, inserts(kept, "words-1", -1).unionByName(inserts(kept, "words-2")))
    return rollup.totals()


ORACLE = r"""
SELECT source, lang, 'words-2' AS tokenizer, count(*) AS n_docs,
    CAST(sum(coalesce(len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]')), 0)) AS BIGINT) AS n_tokens
FROM documents AS d
WHERE text IS NULL OR doc_id IS NULL OR doc_id = (SELECT min(doc_id) FROM documents AS e WHERE e.text = d.text)
GROUP BY source, lang"""
