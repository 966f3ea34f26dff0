"""Approximate nearest neighbours by multi-index hashing.

Vectors are centred, rotated and cut to signs; the rotation is learned (iterative
quantisation: alternate the signs and the orthogonal matrix that fits them best) on a
bounded sample.  A code is split into substrings, and each substring is indexed on its
own.  Two codes within a Hamming radius r must agree to within a smaller radius on some
substring: with thresholds that sum to r - m + 1 over m substrings, probing each index
within its threshold retrieves every code within r.  What is retrieved and lies within
r is ranked by the inner product of the original vectors, in double precision.

The index is cut into blocks of bounded size, each with the indexes of all substrings;
the queries, in blocks too, visit every block.  Equal vectors are one entry of the
index, of which the smallest ids come back, as many as an answer can need.  A query
that meets fewer than k vectors asks again with the widest radius, which holds all.

Vectors that are null, zero, of another length than most or hold null or non-finite
components take no part.  Rows with a null id are left out.  A repeated id is one
vector for each row; a query's own id never answers it.  Ties go to the smaller id.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import Scratch, table

#: Rows that the rotation is learned on, at most.
SAMPLE = 4000
RADIUS = 30
SUBSTRINGS = 8
#: Entries of an index block and queries that visit it at once: a block of the index travels once for each block of queries.
BLOCK, QUERY_BLOCK = 16_384, 16_384
RESULT = "query_id long, vec_id long, score double"


def vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x dims in double precision, from lists that all have ``dims`` finite elements."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def learn(x: np.ndarray, bits: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, dims x bits matrix): principal axes (padded by further rotations), then iterative quantisation."""
    mean = x.mean(axis=0)
    y = x - mean
    _, _, axes = np.linalg.svd(y, full_matrices=True) if len(y) <= 4 * y.shape[1] else (0, 0, np.linalg.eigh(y.T @ y)[1].T[::-1])
    rng = np.random.default_rng(seed)
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        width = min(bits - sum(p.shape[1] for p in parts), y.shape[1])
        base = axes[:width].T
        z = y @ base
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(rounds):
            signs = np.where(z @ r >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ z)
            r = (u @ v).T
        parts.append(base @ r)
    return mean, np.concatenate(parts, axis=1)


def encode(x: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Codes, one byte for each eight signs."""
    return np.packbits((x - mean) @ rotation >= 0, axis=1)


def thresholds(radius: int, m: int) -> list[int]:
    """Substring radii that sum to radius - m + 1; -1 leaves a substring unprobed."""
    spare = max(radius - m + 1, 0 if radius >= m - 1 else -m + 1 + radius)
    return [spare // m + (i < spare % m) for i in range(m)]


class Block:
    """One block of the index.

    For each substring and each of its values, the entries within the substring's
    threshold of that value, as one row of bits: probing a value is one lookup.
    """

    def __init__(self, codes: np.ndarray, radius: int):
        self.words, self.radius = codes.view(np.uint64).reshape(len(codes), -1), radius
        values = np.arange(256, dtype=np.uint8)
        self.near = [np.bitwise_count(values[:, None] ^ codes[None, :, j]) <= most for j, most in enumerate(thresholds(radius, codes.shape[1]))]

    def within(self, query: np.ndarray) -> np.ndarray:
        """Entries whose code is within the radius of the query's."""
        hit = np.zeros(len(self.words), bool)
        for j, near in enumerate(self.near):
            hit |= near[query[j]]
        rows = np.flatnonzero(hit)
        far = np.bitwise_count(self.words[rows] ^ query.view(np.uint64)).sum(axis=1)
        return rows[far <= self.radius]


def nearest(base: DataFrame, queries: DataFrame, k: int = 20, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """The k nearest found of ``base`` for each row of ``queries`` (both: vec_id, embedding)."""
    spark = base.sparkSession
    scratch = Scratch(spark, "ann")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).filter(
            "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x != 0)"
        )

    base, queries = usable(base), usable(queries)
    sizes = base.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").head()
    if sizes is None:
        return empty
    dims, n = sizes
    base, queries = base.filter(F.size("embedding") == dims), queries.filter(F.size("embedding") == dims)

    # Of each distinct vector the k + 1 smallest ids: a query's own one may be among them.
    order = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    first = base.select("embedding", "vec_id").withColumn("r", order).filter(F.col("r") <= k + 1)
    entries = scratch.put(first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    n_entries, n_queries = entries.count(), queries.count()
    if not n_queries:
        return empty
    chance = F.crc32(F.concat_ws("/", F.lit("sample"), F.element_at("ids", 1).cast("string")).cast("binary")) / F.lit(2.0**32)
    sample = entries.filter(chance <= min(1.0, SAMPLE / n_entries)).select("embedding").toArrow()["embedding"].combine_chunks()
    if not len(sample):
        sample = entries.select("embedding").limit(1).toArrow()["embedding"].combine_chunks()
    mean, rotation = learn(vectors(sample, dims), 8 * SUBSTRINGS)

    blocks, query_blocks = math.ceil(n_entries / block), math.ceil(n_queries / QUERY_BLOCK)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    index = entries.select("ids", "embedding", F.pmod(F.xxhash64("embedding"), F.lit(blocks)).cast("int").alias("b"), every(query_blocks).alias("q"))

    def ask(queries: DataFrame, radius: int) -> DataFrame:
        asked = queries.select(F.col("vec_id").alias("query_id"), "embedding", every(blocks).alias("b"), F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("q"))

        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            out_q, out_v, out_s = [], [], []
            if len(left) and len(right):
                x = vectors(left["embedding"].combine_chunks(), dims)
                y = vectors(right["embedding"].combine_chunks(), dims)
                ids = left["ids"].to_pylist()
                smallest = np.array([i[0] for i in ids])
                found = Block(encode(x, mean, rotation), radius)
                for q, code, v in zip(right["query_id"].to_pylist(), encode(y, mean, rotation), y):
                    rows = found.within(code)
                    score = x[rows] @ v
                    if len(rows) > k + 1:
                        cut = np.partition(score, -(k + 1))[-(k + 1)]
                        # the product of a matrix may differ by rounding from that of one row
                        rows = rows[score >= cut - 1e-9 * max(1.0, abs(cut))]
                    score = np.array([float(np.dot(x[r], v)) for r in rows])
                    best = np.lexsort((smallest[rows], -score))
                    met = 0
                    for i in best:
                        if met >= k and score[i] < out_s[-1]:
                            break
                        for vec in ids[rows[i]]:
                            if vec != q:
                                out_q.append(q)
                                out_v.append(vec)
                                out_s.append(score[i])
                                met += 1
            return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})

        got = index.groupBy("b", "q").cogroup(asked.groupBy("b", "q")).applyInArrow(search, RESULT)
        return got.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)

    found = scratch.put(ask(queries, radius), "found")
    if radius < 8 * SUBSTRINGS:
        enough = found.filter(F.col("rank") == min(k, n - 1)).select("query_id")
        short = queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti")
        if not short.isEmpty():
            again = scratch.put(ask(short, 8 * SUBSTRINGS), "again")
            found = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = table(spark, sf_dir, "embeddings")
    return nearest(data, data.filter("vec_id % 20 = 0"))
