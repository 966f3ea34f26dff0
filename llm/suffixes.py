"""Suffix-array deduplication: remove bytes covered by a long string that also starts elsewhere.

Which strings of ``length`` bytes repeat is decided by suffix arrays, built by two-stage
sorting: only suffixes smaller than their successors are sorted directly, the rest are
induced by scanning the buckets of first bytes from left to right, and adjacent suffixes
with a common prefix of ``length`` bytes or more mark repeated strings.

No suffix array spans the corpus.  Each string of ``length`` bytes has an anchor, the
least hash among its grams of ``GRAM`` bytes, which depends on the string alone, so
equal strings have equal anchors at equal offsets.  The strings of a text that share
one anchor occurrence lie in one segment.  Segments travel as digests: equal ones form a
class with a count, and anchors that occur once end here.  A class that has copies and no
rival class at its anchor repeats throughout.  Where classes meet at an anchor, one
segment of each is sent to a task, which sorts all suffixes of its segments together.
An anchor with more than ``MOST`` classes (the edge of a passage in very many documents)
is not gathered: its strings are counted by digest, one row each, combined before the
shuffle.

Texts are UTF-8 bytes and judged as they came in; matches never cross documents.  Null
is the empty text; shorter texts than ``length`` lose nothing.  Rows with a null id are
left out.  Rows that repeat an id are documents of their own, and each is returned.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from llm.common import Scratch, done, table, tidied
from llm.textcodes import byte_chunks, mix, prefix, signed, spans_code

LENGTH = 400
GRAM = 64
#: Bytes of segments that one group sorts together, and the most classes of one anchor that it takes.
TASK_BYTES, MOST = 1_000_000, 512
#: Groups of ``TASK_BYTES`` that a partition has on average: each partition sends the driver some 10 KB of figures.
TOGETHER = 4
#: Bytes of texts whose segments are found at once; a longer text is taken alone.
CHUNK = 1 << 19
#: Neighbouring strings that are counted together at anchors with more classes.
BLOCK = 12

SEGMENTS = "doc_id long, t long, h long, d1 long, d2 long, s0 int, n int"


def window_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of x[i : i + w] for every i that has w elements."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, first string, strings, anchor code) of each segment; strings are numbered by their first byte."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    pre = prefix(data)
    at = np.arange(len(data) - gram + 1)
    code = spans_code(pre, at, at + gram)
    least = window_least((code & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64), length - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    delta = np.zeros(len(anchor) + 1, np.int32)
    long = np.diff(offsets) >= length
    np.add.at(delta, offsets[:-1][long], 1)
    np.add.at(delta, offsets[1:][long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
    if not len(start):
        return none, none, none, none.astype(np.uint64)
    mine = anchor[start]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(mine) != 0) | (np.diff(start) != 1)]))
    s0, n = start[new], np.diff(np.append(new, len(start)))
    return np.searchsorted(offsets, s0, "right") - 1, s0, n, code[mine[new]]


def _rank(x: np.ndarray) -> np.ndarray:
    """Dense ranks from 1; 0 is left for what lies beyond the end."""
    order = np.argsort(x)
    sorted_ = x[order]
    out = np.empty(len(x), np.uint64)
    out[order] = np.cumsum(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]), dtype=np.uint64)
    return out


class Ranks:
    """Order of the substrings of 1, 2, 4 ... 64 symbols at every place of a text."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        used = np.zeros(512, bool)
        used[text] = True
        if used[1:].sum() < 256:  # one byte for each symbol, so that eight fill a word
            first, bits = (np.cumsum(used) - used[0]).astype(np.uint64), 8
        else:
            first, bits = np.arange(512, dtype=np.uint64), 9
        self.by = {1: first[text]}
        for size in (2, 4, 8)[: 2 + (bits == 8)]:
            self.by[size] = (self.by[size // 2] << np.uint64(bits * size // 2)) | self._shift(self.by[size // 2], size // 2)
        for size in (8, 16, 32, 64)[bits == 8 :]:
            small = _rank(self.by[size // 2])
            self.by[size // 2] = small
            self.by[size] = (small << np.uint64(32)) | self._shift(small, size // 2)
        self.by[64] = _rank(self.by[64])

    @staticmethod
    def _shift(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros_like(x)
        if k < len(x):
            out[: len(x) - k] = x[k:]
        return out

    def at(self, size: int, places: np.ndarray) -> np.ndarray:
        """Ranks at places, 0 beyond the end (nothing sorts before the end)."""
        inside = places < self.n
        return np.where(inside, self.by[size][np.where(inside, places, 0)] + np.uint64(1), np.uint64(0))


def suffix_array(text: np.ndarray, depth: int, ranks: Ranks | None = None) -> np.ndarray:
    """Places of ``text`` (symbols below 512) in the order of their suffixes, exact to ``depth`` symbols at least."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    ranks = ranks or Ranks(text)
    # A suffix is smaller than its successor if the next different symbol is larger; the last one never is.
    change = np.flatnonzero(text[1:] != text[:-1])
    following = np.searchsorted(change, np.arange(n))
    small = np.zeros(n, bool)
    has = following < len(change)
    where = change[following[has]]
    small[has] = text[where] < text[where + 1]

    # Stage one: sort the small suffixes directly, by blocks of 64 symbols, ties only.
    order = np.flatnonzero(small)
    group = np.zeros(len(order), np.int64)
    open_ = np.arange(len(order))
    for step in range(0, depth + 64, 64):
        if not len(open_):
            break
        places = order[open_]
        key = ranks.at(64, places + step)
        by = np.argsort((group[open_].astype(np.uint64) << np.uint64(32)) | key)
        places, key, mine = places[by], key[by], group[open_][by]
        order[open_] = places
        new = np.ones(len(open_), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (key[1:] != key[:-1])
        label = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        group[open_] = label
        same = ~new
        tied = same.copy()
        tied[:-1] |= same[1:]
        open_ = open_[tied]

    # Stage two: scan the buckets from the least symbol; each entry induces its larger predecessor.
    symbols = np.unique(text)
    first = np.searchsorted(text[order], symbols) if len(order) else np.zeros(len(symbols), np.int64)
    last = np.searchsorted(text[order], symbols, "right") if len(order) else first
    waiting: dict[int, list[np.ndarray]] = {int(c): [] for c in symbols}
    waiting[int(text[-1])].append(np.array([n - 1]))
    out = []

    def induce(entries: np.ndarray, least: int, strict: bool) -> None:
        before = entries[entries > 0] - 1
        before = before[~small[before]]
        c = text[before]
        for s in np.unique(c):
            if s > least or (s == least and not strict):
                waiting[int(s)].append(before[c == s])

    for c, a, b in zip(symbols, first, last):
        c, done = int(c), []
        while waiting[c]:
            arrived = np.concatenate(waiting[c])
            waiting[c] = []
            done.append(arrived)
            before = arrived[arrived > 0] - 1
            before = before[~small[before]]
            again = before[text[before] == c]
            if len(again):
                waiting[c].append(again)
        entries = np.concatenate([*done, order[a:b]])
        out.append(entries)
        induce(entries, c, True)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, ranks: Ranks, most: int) -> np.ndarray:
    """Symbols that each suffix shares with the one before it in ``order``, up to ``most`` (0 for the first)."""
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for _ in range(-(-most // 64)):
        x, y = a[open_] + shared[open_], b[open_] + shared[open_]
        same = (x < ranks.n) & (y < ranks.n) & (ranks.at(64, x) == ranks.at(64, y))
        open_ = open_[same]
        shared[open_] += 64
    open_ = np.flatnonzero(shared < most)
    for size in (32, 16, 8, 4, 2, 1):
        x, y = a[open_] + shared[open_], b[open_] + shared[open_]
        same = (x < ranks.n) & (y < ranks.n) & (ranks.at(size, x) == ranks.at(size, y))
        shared[open_[same]] += size
    return np.concatenate([[0], np.minimum(shared, most)])


def repeated(texts: list[bytes], counts: np.ndarray, strings: np.ndarray, length: int) -> list[np.ndarray]:
    """Which strings of each segment repeat, among all segments given; counts: copies of each segment."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    text = np.zeros(ends[-1], np.uint16)
    flat = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    text[:] = flat
    text += 1
    text[ends - 1] = 0
    ranks = Ranks(text)
    order = suffix_array(text, length, ranks)
    shared = common_prefixes(order, ranks, length)
    begin = np.repeat(ends - sizes, sizes)
    own = np.arange(len(text)) - begin < np.repeat(strings, sizes)
    hit = np.flatnonzero((shared >= length) & own[order] & np.concatenate([[False], own[order[:-1]]]))
    marked = np.zeros(len(text), bool)
    marked[order[hit]] = marked[order[hit - 1]] = True
    marked |= np.repeat(counts > 1, sizes)
    return [marked[e - z : e - z + n] for e, z, n in zip(ends, sizes, strings)]


def runs(marked: np.ndarray) -> list[int]:
    """Starts and ends of the runs of True, one after the other."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.view(np.int8), [0]])))
    return edge.tolist()


def find_segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(2), CHUNK):
                row, s0, n, code = segments(data, offsets, length, gram)
                view = memoryview(data)
                digest = b"".join([hashlib.blake2b(view[a : a + m - 1 + length], digest_size=16).digest() for a, m in zip(s0.tolist(), n.tolist())])
                pair = np.frombuffer(digest, np.int64).reshape(-1, 2)
                take = pa.array(low + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(signed(code)), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), pa.array((s0 - offsets[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["doc_id", "t", "h", "d1", "d2", "s0", "n"],
                )

    return docs.mapInArrow(tidied(find), SEGMENTS)


def _cut_texts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted (doc_id, t, s0, n, ...) with the bytes of each segment."""
    rows = docs.join(wanted, ["doc_id", "t"])
    return rows.select(*[c for c in wanted.columns if c not in ("doc_id", "t", "s0")], F.substring(F.col("text").cast("binary"), F.col("s0") + 1, F.col("n") + length - 1).alias("segment"))


def _digest(x: bytes | memoryview) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def _count_strings(edges: DataFrame, scratch: Scratch, length: int, gram: int) -> DataFrame:
    """(h, d1, d2, runs) for classes of anchors that have too many to be gathered, by counting digests.

    The strings of a segment are taken in blocks of neighbours, placed by the anchor.  Equal
    strings lie in blocks whose common bytes are equal; a block that is equal as a whole to
    another is settled, and only where different blocks have common bytes in common are
    single strings counted.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for h, d1, d2, copies, n, segment in zip(*(batch.column(c).to_pylist() for c in ("h", "d1", "d2", "copies", "n", "segment"))):
                data = np.frombuffer(segment, np.uint8)
                at = np.arange(len(data) - gram + 1)
                code = spans_code(prefix(data), at, at + gram)
                # the anchor of the first string, as segments() found it
                anchor = int(np.argmin((code[: length - gram + 1] & ~np.uint64(0xFFFFFFFF)) | at[: length - gram + 1].astype(np.uint64)))
                i = 0
                while i < n:
                    b = (anchor - i) // BLOCK
                    m = min(n, anchor - b * BLOCK + 1) - i
                    core = anchor - b * BLOCK
                    rows.append((h, d1, d2, copies, b, _digest(segment[core : core - BLOCK + 1 + length]), _digest(segment[i : i + m - 1 + length] + bytes([(anchor - i) % BLOCK])), i, m, segment[i : i + m - 1 + length]))
                    i += m
            columns = list(zip(*rows)) or [()] * 10
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2 + [pa.int32()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["h", "d1", "d2", "copies", "b", "core", "whole", "i", "m", "bytes"])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (whole, weight, t, _digest(data[t : t + length]))
                for whole, weight, m, data in zip(*(batch.column(c).to_pylist() for c in ("whole", "weight", "m", "bytes")))
                for t in range(m)
            ]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.int64(), pa.int32(), pa.binary()])], ["whole", "weight", "i", "digest"])

    each = scratch.put(edges.mapInArrow(tidied(blocks), "h long, d1 long, d2 long, copies long, b long, core binary, whole binary, i int, m int, bytes binary"), "blocks")
    wholes = each.groupBy("h", "b", "core", "whole").agg(F.sum("copies").alias("weight"), F.first("m").alias("m"), F.first("bytes").alias("bytes"))
    wholes = scratch.put(wholes, "wholes")
    cores = wholes.groupBy("h", "b", "core").agg(F.sum("weight").alias("total"), F.count("*").alias("wholes")).filter("total > 1")
    wholes = wholes.join(cores, ["h", "b", "core"])
    single = scratch.put(wholes.filter("wholes > 1").select("whole", "weight", "m", "bytes").mapInArrow(tidied(strings), "whole binary, weight long, i int, digest binary"), "strings")
    twice = single.groupBy("digest").agg(F.sum("weight").alias("total")).filter("total > 1").select("digest")
    some = single.filter("weight = 1").join(twice, "digest").groupBy("whole").agg(F.flatten(F.collect_list(F.array("i", F.col("i") + 1))).alias("runs"))
    settled = wholes.filter("weight > 1").select("whole", F.array(F.lit(0), F.col("m")).alias("runs"))
    placed = each.select("h", "d1", "d2", "whole", "i").join(some.unionByName(settled), "whole")
    return placed.groupBy("h", "d1", "d2").agg(F.flatten(F.collect_list(F.transform("runs", lambda x: x + F.col("i")))).alias("runs"))


def repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, task_bytes: int = TASK_BYTES, most: int = MOST) -> DataFrame:
    """(doc_id, t, runs): runs of strings that occur elsewhere, by their first bytes; docs: doc_id, t, text."""
    found = scratch.put(find_segments(docs, length, gram), "segments")
    classes = found.groupBy("h", "d1", "d2").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "t", "s0")).alias("one"), F.first("n").alias("n"))
    classes = scratch.put(classes, "classes")
    anchors = classes.groupBy("h").agg(F.count("*").alias("rivals"), F.sum("copies").alias("total")).filter("total > 1")
    classes = scratch.put(classes.join(anchors, "h").select("h", "d1", "d2", "copies", "one.*", "n", "rivals"), "shared")
    scratch.tidy()

    alone = classes.filter("rivals = 1").select("h", "d1", "d2", F.array(F.lit(0), F.col("n")).alias("runs"))
    rivals = classes.filter("rivals > 1").select("h", "d1", "d2", "copies", "doc_id", "t", "s0", "n", "rivals")
    cut = scratch.put(_cut_texts(docs, rivals, length), "cut")
    scratch.tidy()
    size = cut.filter(F.col("rivals") <= most).agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    tasks = max(1, math.ceil(size / task_bytes))

    def sort(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        texts = [x.as_buffer().to_pybytes() for x in group["segment"].combine_chunks()]
        marked = repeated(texts, group["copies"].to_numpy(), group["n"].to_numpy(), length)
        return pa.table({c: group[c] for c in ("h", "d1", "d2")} | {"runs": pa.array([runs(m) for m in marked], pa.list_(pa.int32()))})

    marks = "h long, d1 long, d2 long, runs array<int>"
    sortable = cut.filter(F.col("rivals") <= most).select("h", "d1", "d2", "copies", "n", "segment", F.pmod(F.xxhash64("h"), F.lit(tasks)).alias("task"))
    # Sorting takes a second for a megabyte, so groups are dealt by their number: Spark would join them by their bytes.
    sorted_ = sortable.repartition(math.ceil(tasks / TOGETHER), "task").groupBy("task").applyInArrow(lambda t: done(sort(t)), marks)

    edges = cut.filter(F.col("rivals") > most)
    counted = None if edges.isEmpty() else _count_strings(edges, scratch, length, gram)
    marked = alone.unionByName(sorted_)
    marked = scratch.put((marked.unionByName(counted) if counted is not None else marked).filter(F.size("runs") > 0), "marked")
    placed = found.join(marked, ["h", "d1", "d2"])
    return placed.groupBy("doc_id", "t").agg(F.flatten(F.collect_list(F.transform("runs", lambda x: x + F.col("s0")))).alias("runs"))


def removed(docs: DataFrame, length: int = LENGTH, with_text: bool = False, carry: tuple[str, ...] = (), **limits) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_text also what is left (binary ``kept``).

    ``carry`` names further columns of the input that come along.
    """
    more = F.struct(*[F.col(c) for c in carry] or [F.lit(1).alias("none")]).alias("more")
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), more)
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), "text", "more")
    docs = rows.drop("more")
    scratch = Scratch(docs.sparkSession, "suffixes")
    found = scratch.put(repeats(docs, scratch, length, **limits), "found")
    scratch.tidy()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, digest, kept = [], [], [], [], []
            for text, run in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                count = 0
                n = len(data)
                if run.is_valid:
                    edges = np.asarray(run.values).reshape(-1, 2).astype(np.int64)
                    delta = np.zeros(n + 1, np.int32)
                    np.add.at(delta, edges[:, 0], 1)
                    np.add.at(delta, edges[:, 1] - 1 + length, -1)
                    cover = np.cumsum(delta[:-1]) > 0
                    count = len(runs(cover)) // 2
                    data = np.frombuffer(data, np.uint8)[~cover].tobytes()
                size.append(n)
                gone.append(n - len(data))
                spans.append(count)
                digest.append(hashlib.sha256(data).hexdigest())
                kept.append(data)
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(kept, pa.binary())] * with_text, *batch.columns[3:]], names + ["kept"] * with_text + ["more"] * bool(carry))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    fields = StructType.fromDDL(schema).fields + [rows.schema["more"]] * bool(carry)
    wanted = ["doc_id", "text", "runs"] + ["more"] * bool(carry)
    out = rows.join(found, ["doc_id", "t"], "left").select(*wanted).mapInArrow(tidied(cut), StructType(fields))
    return out.select(*[f.name for f in fields if f.name != "more"], "more.*") if carry else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and what is left of every text (``text``; characters that a cut has broken are replaced)."""
    cut = removed(table(spark, sf_dir, "documents"), with_text=True)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
