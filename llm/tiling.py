"""Benchmark decontamination by greedy string tiling.

A document and a test item are compared as word sequences (runs of letters, digits and
non-ASCII bytes, A-Z lower-cased).  Shared seeds of ``least`` words join documents with
the items that they may hold.  Such a pair is tiled: running Karp-Rabin hashes find the
longest matches of words not marked yet, these are marked in both texts, and again with
shorter ones down to ``least`` words.  Tiles need not be in order, so a reordered passage
counts in full.  An item whose share of marked words reaches ``coverage`` is contained.

Items of up to ``BLOCK_WORDS`` words are sent whole to all tasks, which join documents with
them as they are read.  A larger benchmark is joined by shuffles: a map of fixed size says
which seeds any item has; documents without such a seed are let go where they are read, the
seeds of the others meet the items' seeds, pairs that share enough of an item's words come
together with both texts, and are tiled.  The documents are read once either way, and the
benchmark is never cut.

An item of fewer than ``least`` words is found where all of it occurs, word after word;
one without words never is.  Null texts are empty.  Rows with a
null id are left out on both sides.  Rows that repeat an id are tested on their own and
can give a row each.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import Scratch, table, tidied
from llm.textcodes import BASE, byte_chunks, lower, mix, prefix, spans_code

LEAST = 5
COVERAGE = 0.5
#: Words of items that are sent to the tasks.
BLOCK_WORDS = 2_000_000

_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, starts, words before each row) of the words of each row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = _SOLID[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid & (np.concatenate([[True], ~solid[:-1]]) | edge[:-1]))
    end = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]]) | edge[1:])) + 1
    return spans_code(prefix(lower(data)), start, end), start, np.searchsorted(start, offsets)


def grams(codes: np.ndarray, k: int) -> np.ndarray:
    """Code of each run of k words."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = mix(out * BASE + codes[j : j + n])
    return out


def _ahead(free: np.ndarray) -> np.ndarray:
    """How many free words follow each place, itself included."""
    stop = np.append(np.flatnonzero(~free), len(free))
    at = np.arange(len(free))
    return stop[np.searchsorted(stop, at)] - at


def tile(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in text, words) of two word sequences."""
    free_i, free_t = np.ones(len(item), bool), np.ones(len(text), bool)
    pre_i, pre_t = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(len(x)))]) for x in (item, text))
    inv = _powers(max(len(item), len(text)) + 1, True)
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), 32))
    while True:
        i = np.flatnonzero(_ahead(free_i) >= size)
        t = np.flatnonzero(_ahead(free_t) >= size)
        found: list[tuple[int, int, int]] = []
        if len(i) and len(t):
            hash_i = (pre_i[i + size] - pre_i[i]) * inv[i]
            hash_t = (pre_t[t + size] - pre_t[t]) * inv[t]
            order = np.argsort(hash_t, kind="stable")
            low, high = np.searchsorted(hash_t[order], hash_i, "left"), np.searchsorted(hash_t[order], hash_i, "right")
            for k in np.flatnonzero(high > low):
                p = int(i[k])
                for q in t[order[low[k] : high[k]]].tolist():
                    if p and q and free_i[p - 1] and free_t[q - 1] and item[p - 1] == text[q - 1]:
                        continue  # part of a longer match
                    n = 0
                    while p + n < len(item) and q + n < len(text) and free_i[p + n] and free_t[q + n] and item[p + n] == text[q + n]:
                        n += 1
                    if n >= size:
                        found.append((-n, p, q))
        longest = -min(found)[0] if found else 0
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for n, p, q in sorted(found):
            n = -n
            if free_i[p : p + n].all() and free_t[q : q + n].all():
                free_i[p : p + n] = free_t[q : q + n] = False
                tiles.append((p, q, n))
            else:
                again = True  # what is left of it may be long enough still
        if again:
            continue
        if size == least:
            return tiles
        size = max(least, size // 2)


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    from llm import textcodes

    return textcodes._powers("i" if inverse else "b", n)


RESULT = "doc_id long, item_id long, n_matched int, n_words int, coverage double, n_tiles int, starts array<int>, ends array<int>"


def contained(docs: DataFrame, items: DataFrame, least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and an item that it holds; starts and ends are byte places of the tiles in the document."""
    spark = docs.sparkSession
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = items.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    words = items.agg(F.sum(F.size(F.split("text", r"[^\p{L}\p{N}]+")))).first()[0] or 0
    if not words:
        return spark.createDataFrame([], RESULT)
    if words <= block_words:
        return _contained(docs, items.orderBy("item_id").toArrow(), least, coverage)
    return _joined(docs, items, least, coverage)


def held(item: np.ndarray, text: np.ndarray, places: np.ndarray, start: np.ndarray, size: int, least: int, coverage: float) -> tuple | None:
    """(n_matched, n_words, coverage, n_tiles, starts, ends) if a text of ``size`` bytes, whose words begin at ``start``, holds an item; ``places`` are those of shared seeds in it."""
    shortest = min(least, len(item))
    reach = np.zeros(len(item), bool)
    for p in places:
        reach[p : p + shortest] = True
    if reach.sum() < coverage * len(item):
        return None  # tiles lie within the shared seeds
    tiles = sorted(tile(item, text, shortest), key=lambda x: x[1])
    n = sum(x[2] for x in tiles)
    if n < coverage * len(item):
        return None
    ends = [int(start[q + m] if q + m < len(start) else size) for _, q, m in tiles]
    return n, len(item), n / len(item), len(tiles), [int(start[q]) for _, q, _ in tiles], ends


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 8
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "n_matched", "n_words", "coverage", "n_tiles", "starts", "ends"])


def seeds_of(codes: np.ndarray, at: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed, row, place in its row) of all runs of so many words that lie in one row."""
    seed, row, place = [], [], []
    for k in lengths:
        gram = grams(codes, k)
        where = np.arange(len(gram))
        mine = np.searchsorted(at, where, "right") - 1
        whole = where + k <= at[mine + 1] if len(gram) else where.astype(bool)
        seed.append(gram[whole])
        row.append(mine[whole])
        place.append((where - at[mine])[whole] if len(gram) else where)
    return tuple(np.concatenate([*x, np.zeros(0, t)]).astype(t) for x, t in ((seed, np.uint64), (row, np.int64), (place, np.int64)))


def _joined(docs: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    """The same by a join on seeds, for benchmarks that no task can hold."""
    from llm.collocations import _full, bit_map

    scratch = Scratch(docs.sparkSession, "tiling")
    items = scratch.put(items.withColumn("i", F.monotonically_increasing_id()), "items")

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1)):
                codes, _, at = tokens(data, offsets)
                n = np.diff(at)
                # An item of a few words has one seed, itself.
                seed, row, place = seeds_of(codes, at, list(range(1, least + 1)))
                size = np.concatenate([np.full(len(grams_), k) for k, grams_ in _lengths(codes, at, least)]) if len(seed) else seed.astype(np.int64)
                mine = size == np.minimum(n[row], least)
                number = batch.column(0).to_numpy()[low : low + len(n)]
                yield pa.RecordBatch.from_arrays([pa.array(seed[mine].view(np.int64)), pa.array(number[row[mine]]), pa.array(place[mine]), pa.array(n[row[mine]])], ["code", "i", "place", "words"])

    seeds = scratch.put(items.select("i", "text").mapInArrow(tidied(item_seeds), "code long, i long, place long, words long"), "seeds")
    lengths = sorted(r[0] for r in seeds.select(F.least("words", F.lit(least))).distinct().collect())  # ``least`` at most
    known = bit_map(seeds)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1)):
                codes, _, at = tokens(data, offsets)
                seed, row, _ = seeds_of(codes, at, lengths)
                some = _full(known.value, seed)
                pairs = np.unique(np.stack([row[some].astype(np.uint64), seed[some]]), axis=1)
                rows, first = np.unique(pairs[0].astype(np.int64), return_index=True)
                parts = pa.ListArray.from_arrays(pa.array(np.append(first, pairs.shape[1]), pa.int32()), pa.array(pairs[1].view(np.int64)))
                yield pa.RecordBatch.from_arrays([c.take(pa.array(low + rows)) for c in batch.columns] + [parts], ["doc_id", "text", "codes"])

    left = docs.mapInArrow(tidied(passing), "doc_id long, text string, codes array<long>").withColumn("r", F.monotonically_increasing_id())
    left = scratch.put(left, "documents")
    shared = left.select("r", F.explode("codes").alias("code")).join(seeds, "code").groupBy("r", "i", "words").agg(F.collect_list("place").alias("places"))
    enough = F.size("places") * F.least("words", F.lit(least)) >= coverage * F.col("words")
    both = shared.filter(enough).join(items.withColumnRenamed("text", "item"), "i").join(left.select("r", "doc_id", "text"), "r")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, number, places, item, text in zip(*batch.columns):
                words = [tokens(np.frombuffer(x.as_py().encode(), np.uint8), np.array([0, len(x.as_py().encode())])) for x in (item, text)]
                size = len(text.as_py().encode())
                found = held(words[0][0], words[1][0], np.asarray(places.as_py()), words[1][1], size, least, coverage)
                if found:
                    rows.append((doc.as_py(), number.as_py(), *found))
            yield _batch(rows)

    return both.select("doc_id", "item_id", "places", "item", "text").mapInArrow(tidied(test), RESULT)


def _lengths(codes: np.ndarray, at: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, seeds of k words), in the order of ``seeds_of``."""
    for k in range(1, least + 1):
        yield k, seeds_of(codes, at, [k])[0]


def _contained(docs: DataFrame, block: pa.Table, least: int, coverage: float) -> DataFrame:
    ids, sequences = block["item_id"].to_pylist(), []
    for _, data, offsets in byte_chunks(block["text"]):
        codes, _, at = tokens(data, offsets)
        sequences += [codes[at[i] : at[i + 1]] for i in range(len(at) - 1)]
    # An item of a few words has one seed, itself; seeds of different lengths never have one code.
    seeds = [grams(s, min(least, len(s))) if len(s) else np.zeros(0, np.uint64) for s in sequences]
    lengths = sorted({min(least, len(s)) for s in sequences if len(s)})
    seed = np.concatenate([*seeds, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
    place = np.concatenate([*(np.arange(len(s)) for s in seeds), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(seed, kind="stable")
    # One copy for each executor, of a bounded block.
    sent = docs.sparkSession.sparkContext.broadcast((seed[order], owner[order], place[order], sequences, ids))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, owner, place, sequences, ids = sent.value
        for batch in batches:
            doc_ids = batch.column(0)
            rows: list[tuple] = []
            for low, data, offsets in byte_chunks(batch.column(1)):
                codes, start, at = tokens(data, offsets)
                hits = []
                for k in lengths:
                    gram = grams(codes, k)
                    where = np.searchsorted(seed, gram)
                    hit = np.flatnonzero((where < len(seed)) & (seed[np.minimum(where, max(len(seed) - 1, 0))] == gram)) if len(seed) else where[:0]
                    row = np.searchsorted(at, hit, "right") - 1
                    whole = hit + k <= at[row + 1] if len(hit) else hit.astype(bool)
                    hits.append((gram[hit[whole]], row[whole]))
                found, row = (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                for r in np.unique(row):
                    text = codes[at[r] : at[r + 1]]
                    mine = np.unique(found[row == r])
                    a, b = np.searchsorted(seed, mine, "left"), np.searchsorted(seed, mine, "right")
                    at_seed = np.concatenate([np.arange(x, y) for x, y in zip(a, b)])
                    for k in np.unique(owner[at_seed]):
                        got = held(sequences[k], text, place[at_seed[owner[at_seed] == k]], start[at[r] : at[r + 1]] - offsets[r], int(offsets[r + 1] - offsets[r]), least, coverage)
                        if got:
                            rows.append((doc_ids[low + int(r)].as_py(), ids[k], *got))
            yield _batch(rows)

    return docs.mapInArrow(tidied(find), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_matched", "n_words", "coverage", "n_tiles")
