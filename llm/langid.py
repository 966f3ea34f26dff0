"""Language identification by nearest centroid.

A text becomes a vector of byte n-grams (two to four bytes, letters lower-cased where
they are A-Z, everything that cannot be part of a letter a single space), hashed into a
fixed number of dimensions, damped, weighted by inverse document frequency and
normalised.  Each language has several centroids, found by spherical k-means over its
training vectors.  A text gets the language of the centroid with the largest cosine; a
text nearer to none than ``min_score`` can be rejected.  So can a text that is far for
its number of distinct n-grams: the model then knows how near the texts of a language
and their beginnings come to centroids that are made without them.

Training takes at most ``per_language`` labelled rows of each language (a documented
bound for the fit alone; prediction reads whole texts of all rows).  Null text, and
text without a letter, is ``und`` with score 0.  Without any training row everything is
``und``.  Rows with a null id are predicted too.  Equal scores go to the language that
sorts first.  Repeated rows each get a row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from llm.common import crc_of_id, table, tidied
from llm.textcodes import byte_chunks

DIMENSIONS = 4096
GRAMS = (2, 3, 4)
CENTROIDS = 4
#: The most training rows of a language.
PER_LANGUAGE = 800
UNKNOWN = "und"
#: A text is far below this share of the cosine that all but ``LOW`` of its language's texts reach.
NEAR, LOW = 0.7, 0.01
#: Bytes of the beginnings of training texts, so that every length has examples; the least examples of a number of n-grams.
BEGINNINGS, EXAMPLES = (24, 48, 96, 192, 384, 768, 1536), 30
_STEPS = 2 * DIMENSIONS.bit_length()

_MAP = np.full(256, 32, np.uint8)
_MAP[97:123] = np.arange(97, 123)
_MAP[65:91] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def gram_counts(data: np.ndarray, offsets: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """Counts (rows x dims) of the hashed n-grams of each row; n-grams never cross rows."""
    rows = len(offsets) - 1
    seen = _MAP[data]
    drop = np.zeros(len(seen), bool)
    drop[1:] = (seen[1:] == 32) & (seen[:-1] == 32)  # runs of separators count as one
    row = np.repeat(np.arange(rows), np.diff(offsets))[~drop]
    seen = seen[~drop].astype(np.uint32)
    out = np.zeros(rows * dims, np.float32)
    for n in GRAMS:
        if len(seen) < n:
            continue
        code = np.zeros(len(seen) - n + 1, np.uint32)
        for j in range(n):
            code = (code << np.uint32(8)) | seen[j : len(seen) - n + 1 + j]
        code = (code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B % 2**32)) >> np.uint32(16)
        inside = row[: len(code)] == row[n - 1 :]
        at = row[: len(code)][inside] * dims + (code[inside] % np.uint32(dims)).astype(np.int64)
        out += np.bincount(at, minlength=rows * dims).astype(np.float32)
    return out.reshape(rows, dims)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row holds a letter of any script."""
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    total = np.concatenate([[0], np.cumsum(letter)])
    found = total[offsets[1:]] > total[offsets[:-1]]
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    for i in np.flatnonzero(~found & (high[offsets[1:]] > high[offsets[:-1]])):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


def step_of(counts: np.ndarray) -> np.ndarray:
    """The number of distinct n-grams of each row, in half octaves."""
    return np.floor(2 * np.log2(np.maximum((counts > 0).sum(axis=1), 1))).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (languages x CENTROIDS) x dims, unit length or zero
    floors: np.ndarray | None = None  # languages x _STEPS: lower cosines are far

    def far(self, counts: np.ndarray, best: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        return cosine < self.floors[best, step_of(counts)] if self.floors is not None else np.zeros(len(best), bool)

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.maximum(norm, 1e-12)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, cosine) of each row."""
        cosine = (self.weigh(counts) @ self.centroids.T).reshape(len(counts), len(self.languages), -1).max(axis=2)
        best = cosine.argmax(axis=1)
        return best, np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from far apart rows; always k centroids, some of which may be equal."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centers = x[chosen].copy()
    for _ in range(rounds):
        mine = (x @ centers.T).argmax(axis=1)
        for j in range(k):
            if (mine == j).any():
                total = x[mine == j].sum(axis=0)
                centers[j] = total / max(np.linalg.norm(total), 1e-12)
    return centers


def _floors(model: Model, langs: np.ndarray, x: np.ndarray, cut: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least cosines by language and step, from texts and beginnings against centroids of the other half of the texts.

    A step with few examples takes those of smaller steps too, whose cosines are lower; without enough it has no floor.
    """
    out = np.zeros((len(model.languages), _STEPS))
    for k, lang in enumerate(model.languages):
        own = np.flatnonzero(langs == lang)
        halves = own[::2], own[1::2]
        if not len(halves[1]):
            continue
        found: list[list[float]] = [[] for _ in range(_STEPS)]
        for mine, others in (halves, halves[::-1]):
            centers, ours = _kmeans(x[others], CENTROIDS), set(mine.tolist())
            rows = [c for c in cut if c[0] in ours]
            for first in range(0, len(rows), 256):
                dense = np.zeros((len(rows[first : first + 256]), DIMENSIONS), np.float32)
                for i, (_, at, n) in enumerate(rows[first : first + 256]):
                    dense[i, at] = n
                for s, c in zip(step_of(dense), (model.weigh(dense) @ centers.T).max(axis=1)):
                    found[s].append(float(c))
            for s, c in zip(step_of(x[mine]), (x[mine] @ centers.T).max(axis=1)):
                found[s].append(float(c))
        for s in range(_STEPS):
            low, seen = s, found[s]
            while len(seen) < EXAMPLES and low:
                low -= 1
                seen = seen + found[low]
            if len(seen) >= EXAMPLES:
                out[k, s] = NEAR * np.quantile(seen, LOW)
    return out


def fit(training: DataFrame, per_language: int = PER_LANGUAGE, floors: bool = False) -> Model | None:
    """A model from rows (doc_id, text, lang), with floors if wanted; rows without text or language take no part.

    Which rows make up the bounded sample depends on a hash of the id alone.
    """
    usable = training.filter("text is not null and lang is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = usable.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    chance = (F.crc32(F.concat_ws("/", F.lit("sample"), F.col("doc_id").cast("string")).cast("binary")) + 0.5) / F.lit(2.0**32)
    sample = usable.filter(chance <= share[F.col("lang")])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(0)):
                got = gram_counts(data, offsets)
                where = [np.flatnonzero(x).astype("<u2") for x in got]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(low, len(got)), pa.array([w.tobytes() for w in where], pa.binary()), pa.array([x[w].astype("<f4").tobytes() for x, w in zip(got, where)], pa.binary()), pa.array(beginnings(data, offsets), pa.list_(pa.binary()))],
                    ["lang", "at", "n", "cut"],
                )

    def beginnings(data: np.ndarray, offsets: np.ndarray) -> list[list[bytes]]:
        texts = [data[a : min(b, a + BEGINNINGS[-1])].tobytes() for a, b in zip(offsets, offsets[1:])] if floors else []
        return [[t[:n] for n in BEGINNINGS if n < len(t)] for t in texts] or [[] for _ in offsets[1:]]

    rows = sample.select("text", "lang").mapInArrow(tidied(features), "lang string, at binary, n binary, cut array<binary>").toArrow()
    langs = np.array(rows["lang"].to_pylist(), object)
    languages = sorted(set(langs))
    if not languages:
        return None
    x = np.zeros((len(langs), DIMENSIONS), np.float32)
    for i, (at, n) in enumerate(zip(rows["at"], rows["n"])):
        x[i, np.frombuffer(at.as_buffer(), "<u2")] = np.frombuffer(n.as_buffer(), "<f4")
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    model = Model(languages, idf, np.zeros((0, DIMENSIONS), np.float32))
    x = model.weigh(x)
    model.centroids = np.concatenate([_kmeans(x[langs == lang], CENTROIDS) for lang in languages]).astype(np.float32)
    if floors:
        cut = []
        for i, begun in enumerate(rows["cut"].to_pylist()):
            data = np.frombuffer(b"".join(begun), np.uint8)
            for row in gram_counts(data, np.concatenate([[0], np.cumsum([len(b) for b in begun], dtype=np.int64)])):
                at = np.flatnonzero(row)
                cut.append((i, at.astype(np.uint16), row[at]))
        model.floors = _floors(model, langs, x, cut)
    return model


def annotate(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score (which it must not hold yet) for every row, in one pass."""
    text = docs.columns.index("text")

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, data, offsets in byte_chunks(batch.column(text)):
                for first in range(0, len(offsets) - 1, 256):
                    some = offsets[first : first + 257]
                    part = data[some[0] : some[-1]]
                    some = some - some[0]
                    known = has_letter(part, some)
                    if model:
                        counts = gram_counts(part, some)
                        best, score = model.predict(counts)
                        known &= ~model.far(counts, best, score)
                        names += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                        scores.append(np.where(known, score, 0.0).astype(np.float64))
                    else:
                        names += [UNKNOWN] * len(known)
                        scores.append(np.zeros(len(known)))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(tidied(classify), schema)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    return annotate(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model).drop("text")


def reject(predictions: DataFrame, min_score: float) -> DataFrame:
    """Predictions with far ones turned into ``und``."""
    return predictions.withColumn("lang_pred", F.when(F.col("score") < min_score, UNKNOWN).otherwise(F.col("lang_pred")))


def held_out():
    """Rows never trained on; a null id is held out."""
    return F.coalesce(crc_of_id() % 3 == 1, F.lit(True))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
