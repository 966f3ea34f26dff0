"""Periodic runs of words, by the suffix tree of each document.

A run is a longest stretch of words that repeats with a smallest period q and is at least
``min_words`` and ``min_repeats`` * q words long.  As Stoye and Gusfield find them: two
suffixes i and i + q whose longest common beginning is exactly q words long are a
branching tandem repeat at i, and part in the suffix tree at a node of depth q.  So at
each node the leaves of the smaller half alone are visited, and for each leaf the leaves
q words before and behind are looked for in the other half.  Every run ends in one such
repeat of its period; rotating it to the left as long as words agree gives the run, and
repeats of one stretch are merged to that with the smallest period.

The tree is held as a suffix array with common beginnings (ranks by doubling, whose levels
give the beginnings) and split into two halves at each of these.  A node with fewer leaves
than a run has repeats cannot end a run, which is why most are left out.  Batches of
documents are worked on at once; a document's tree takes memory in proportion to its
words and to the logarithm of its longest repeat.  Words are told apart exactly.

Null text has no words.  Rows that repeat an id are rows of their own; a null id stays
null.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import crc_of_id, table, tidied
from llm.textcodes import byte_chunks, words

MIN_WORDS, MIN_REPEATS = 24, 3
#: Bytes of text that are worked on at once (a longer text alone), and leaves that are looked up at once.
TEXT_BYTES, LEAVES = 2 << 20, 1 << 20

FOUND = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def suffixes(word: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order inside their documents, place of each, words that each has in common with the one before)."""
    n = len(word)
    key = doc.astype(np.int64) * (int(word.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, h = [], 1
    alone = new & np.append(new[1:], True)
    slots = np.flatnonzero(~alone)
    while len(slots):
        levels.append(rank.astype(np.int32))
        some = order[slots]
        key = rank[some] * (n + 1) + np.where(some + h < end[some], rank[np.minimum(some + h, n)] + 1, 0)
        by = np.argsort(key, kind="stable")
        some, key = some[by], key[by]
        order[slots] = some
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        rank[some] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        slots, h = slots[~(new & np.append(new[1:], True))], 2 * h
    common = np.zeros(n + 1, np.int32)
    if levels:
        at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
        a, b = order[at - 1].copy(), order[at].copy()
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a] == levels[k][b]
            step = same.astype(np.int64) << k
            a, b = a + step, b + step
        common[at] = a - order[at - 1]
    return order, rank[:n], common


def _nearest(value: np.ndarray, at: np.ndarray, step: int, equal: bool) -> np.ndarray:
    """The next places (before or behind) with a smaller value, or an equal one."""
    n = len(value)
    to = np.clip(np.arange(n) + step, 0, n - 1)
    some = at
    while len(some):
        there = to[some]
        far = value[there] > value[some] if equal else value[there] >= value[some]
        some = some[far]
        to[some] = to[to[some]]
    return to[at]


def branching_repeats(order: np.ndarray, rank: np.ndarray, common: np.ndarray, min_words: int, min_repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words of one half) of tandem repeats that part where they end."""
    value = common.astype(np.int64)
    value[0] = value[-1] = -1
    at = np.flatnonzero(value > 0)
    low, high = _nearest(value, at, -1, False), _nearest(value, at, 1, False)
    depth = value[at]
    enough = high - low >= np.maximum(min_repeats, min_words // depth)
    at, high, depth = at[enough], high[enough], depth[enough]
    low = _nearest(value, np.flatnonzero(value > 0), -1, True)[enough]  # halves of a node with more than two children
    left = at - low <= high - at
    first, last = np.where(left, low, at), np.where(left, at, high)
    other, beyond = np.where(left, at, low), np.where(left, high, at)
    size = last - first
    total, n = np.cumsum(size), len(rank)
    begins, halves = [], []
    cuts = [0, *np.unique(np.searchsorted(total, np.arange(LEAVES, int(total[-1]) if len(total) else 0, LEAVES), "right")).tolist(), len(size)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        node = np.repeat(np.arange(a, b), size[a:b])
        leaf = order[np.arange(len(node)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b]) + first[node]]
        for sign in (1, -1):
            mate = leaf + sign * depth[node]
            where = np.where((mate >= 0) & (mate < n), rank[np.clip(mate, 0, n - 1)], -1)
            hit = (where >= other[node]) & (where < beyond[node])
            begins.append(np.minimum(leaf, mate)[hit])
            halves.append(depth[node][hit])
    return (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (begins, halves))


def _rotations(word: np.ndarray, first: np.ndarray, begin: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How many words each repeat can be rotated to the left inside its document, which begins at ``first``."""
    far, some, block = np.zeros(len(begin), np.int64), np.arange(len(begin)), 16
    while len(some):
        at = begin[some] - 1 - far[some]
        places = at[:, None] - np.arange(block)
        inside = places >= first[some][:, None]
        places = np.maximum(places, 0)
        same = inside & (word[places] == word[places + period[some][:, None]])
        whole = same.all(1)
        far[some] += np.where(whole, block, same.argmin(1))
        some = some[whole]
        block = max(16, min(2 * block, LEAVES // max(1, len(some))))
    return far


def runs(word: np.ndarray, at: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, period) of the runs of documents word[at[i]:at[i + 1]], by their first word, then period."""
    count = np.diff(at)
    doc = np.repeat(np.arange(len(count)), count)
    first, end = np.repeat(at[:-1], count), np.repeat(at[1:], count)
    begin, period = branching_repeats(*suffixes(word, doc, end), min_words, min_repeats)
    stop = begin + 2 * period
    order = np.lexsort((period, stop))
    begin, period, stop = begin[order], period[order], stop[order]
    starts, stops, periods = [], [], []
    while len(begin):
        # Of the repeats that end at one word, the shortest; those of its multiples inside its run are the same run.
        head = np.ones(len(stop), bool)
        head[1:] = stop[1:] != stop[:-1]
        which = np.cumsum(head) - 1
        h = np.flatnonzero(head)
        from_ = np.empty(len(h), np.int64)
        for low in range(0, len(h), LEAVES // 16):
            part = h[low : low + LEAVES // 16]
            from_[low : low + len(part)] = begin[part] - _rotations(word, first[begin[part]], begin[part], period[part])
        starts.append(from_)
        stops.append(stop[h])
        periods.append(period[h])
        same = (period % period[h][which] == 0) & (begin >= from_[which])
        begin, period, stop = begin[~same], period[~same], stop[~same]
    start, stop, period = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (starts, stops, periods))
    keep = stop - start >= np.maximum(min_words, min_repeats * period)
    start, stop, period = start[keep], stop[keep], period[keep]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def _word_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers that tell words apart, bytes of all words each with a space behind it)."""
    size = end - start
    total = np.cumsum(size)
    solid = data[np.repeat(start - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], total]).astype(np.int64)), pa.py_buffer(solid)])
    spaced = np.full(len(solid) + len(size), 32, np.uint8)
    spaced[np.arange(len(solid)) + np.repeat(np.arange(len(size)), size)] = solid
    return column.dictionary_encode().indices.to_numpy(), spaced


def _collapsed(spaced: np.ndarray, size: np.ndarray, kept: np.ndarray, at: np.ndarray) -> pa.Array:
    """Kept words of each document, joined by one space."""
    length = np.where(kept, size + 1, 0)
    total = np.concatenate([[0], np.cumsum(length)])[at]
    out = spaced if kept.all() else spaced[np.repeat(kept, size + 1)]
    # the last space of each document that has words left
    gone = np.unique(total[1:][np.diff(total) > 0]) - 1
    left = np.ones(len(out), bool)
    left[gone] = False
    offsets = total - np.searchsorted(gone, total, "left")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out[left]))]).cast(pa.binary())


def periodic(docs: DataFrame, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """(doc_id, runs, collapsed): runs by their first word (from 0), then period; words of the text without those that a run has after its first period."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1), TEXT_BYTES):
                start, end, at = words(data, offsets)
                word, spaced = _word_bytes(data, start, end)
                begin, length, period = runs(word, at, min_words, min_repeats)
                change = np.zeros(len(word) + 1, np.int64)
                np.add.at(change, begin + period, 1)
                np.add.at(change, begin + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                where = np.searchsorted(begin, at)
                doc = np.searchsorted(at, begin, "right") - 1
                each = pa.StructArray.from_arrays([pa.array(begin - at[doc]), pa.array(length), pa.array(period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(at) - 1), pa.ListArray.from_arrays(pa.array(where, pa.int32()), each), _collapsed(spaced, end - start, kept, at)],
                    ["doc_id", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(find), FOUND)


def strongest(runs: Column) -> Column:
    """The run with the most repeats; of equal ones the first, then that with the least period."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best))


def repeated_words(docs: DataFrame) -> DataFrame:
    """Documents with the words of one in ten, chosen by the id's checksum h, made to repeat: of its n words, those from
    a = floor(h / 10) % n on become the first 1 + floor((n - a) / (3 + floor(h / 10) % 8)) of them again and again."""
    h = crc_of_id()
    g = F.floor(h / 10)
    all_words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("words").cast("long")
    a, p = F.col("g") % n, F.col("p")
    chosen = docs.withColumns({"g": g, "words": F.when(h % 10 == 0, all_words)}).withColumn("a", F.when(n > 0, a))
    chosen = chosen.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    said = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.element_at("words", (F.col("a") + (i - F.col("a")) % p + 1).cast("int"))))
    return chosen.select("doc_id", F.when(n > 0, F.array_join(said, " ")).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic(repeated_words(table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string"))))
    best, line = strongest(F.col("runs")), lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
