"""Language-model scoring: Katz backoff over n-grams, down to unigrams and the unknown word.

Training counts are discounted by Good-Turing; what the discounts free is given to the
next lower order, with weights that make each distribution sum to one exactly:

    P(w | h) = d(c) c(h w) / c(h)      if h w was seen, else  a(h) P(w | h')
    P(w)     = d(c) c(w) / N           if w was seen, else    what is left, the unknown word

where h' is h without its first word.  A token is evaluated recursively: its longest
n-gram, or the weight of its context times what the shorter one gives.  Each text starts
from start tokens and ends with an end token.  Discounts apply to counts up to ``TOP``;
where Good-Turing has no usable value (too few counts of counts) absolute discounting by
one half takes its place.  A context whose counts are all above ``TOP`` frees nothing; it
is given one more count, so that something is left for the unseen.

Tables.  Texts are cut into chunks of bounded size, each with its own small dictionary.
The table of words is partitioned by word, that of n-grams by context; a context with
many tokens is spread over partitions by its words as well, so that no word and no
context is hot.  A chunk asks each table once for each of its distinct entries, whatever
their frequency, and gets back counts in the order of the questions.  Statistics of a
context, from which its backoff weight follows, come back only where the chunk needs
them; those of a spread context are sums over its partitions.  Words are numbered by
falling frequency, so that questions are small.

Null text is the empty text: the end token alone.  Rows with a null id are left out; a
repeated id is scored once for each row.  Without training rows every word is unknown
with probability one.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import Scratch, crc_of_id, done, table, tidied
from llm.textcodes import byte_chunks, mix, word_codes

ORDER = 3
#: Discounted counts are 1 to TOP.
TOP = 5
CHUNK_BYTES = 4 << 20
#: Entries (word or n-gram of a chunk) that one task answers, about.
TASK_ENTRIES = 500_000
#: A context with so many times fewer tokens than that is not spread.
SPREAD = 4
ADD = 0.1
END = np.uint64(0x5851F42D4C957F2D)
#: The number of the start token; words are numbered from 1.
START = 0


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, one after the other: bytes by their place, as many as the largest number needs, compressed."""
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        width = (int(x.max()).bit_length() + 7) // 8 if x.dtype.kind == "u" and len(x) else x.itemsize
        flat = x.view(np.uint8).reshape(-1, x.itemsize)
        out += [np.array([len(x), width], "<u4").tobytes(), *(flat[:, i].tobytes() for i in range(width))]
    data = b"".join(out)
    return np.array([len(data)], "<u4").tobytes() + pa.compress(data, "zstd", asbytes=True)


def unpacked(blob: bytes | pa.Buffer, *kinds: str) -> list[np.ndarray]:
    data = pa.decompress(memoryview(blob)[4:], int(np.frombuffer(blob, "<u4", 1)[0]), "zstd")
    out, at = [], 0
    for kind in kinds:
        n, width = np.frombuffer(data, "<u4", 2, at).tolist()
        x = np.zeros(n, kind)
        flat = x.view(np.uint8).reshape(n, x.itemsize)
        for i in range(width):
            flat[:, i] = np.frombuffer(data, np.uint8, n, at + 8 + i * n)
        out.append(x)
        at += 8 + n * width
    return out


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, a place of each, the number of each place's key)."""
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return key[new], order[new], number


def joint(columns: list[np.ndarray]) -> np.ndarray:
    """One number for equal rows of numbers (not negative), in the order of the rows."""
    out = columns[0].astype(np.uint64)
    for x in columns[1:]:
        if not len(x):
            return out
        bits = int(x.max()).bit_length()
        if int(out.max()).bit_length() + bits > 64:
            out = grouped(out)[2].astype(np.uint64)
        if int(out.max()).bit_length() + bits > 64:
            x = grouped(x)[2]
            bits = int(x.max()).bit_length()
        out = (out << np.uint64(bits)) | x.astype(np.uint64)
    return out


def discounts(of: np.ndarray) -> np.ndarray:
    """Factor for counts 0 to TOP from counts of counts of[0..TOP + 1]; larger counts keep theirs."""
    d = np.ones(TOP + 1)
    n1, last = float(of[1]), float(of[TOP + 1])
    common = (TOP + 1) * last / n1 if n1 else 1.0
    for r in range(1, TOP + 1):
        star = (r + 1) * of[r + 1] / (r * of[r]) if of[r] else 0.0
        value = (star - common) / (1 - common) if common < 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def discounted(d: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= TOP, d[np.minimum(counts, TOP).astype(np.int64)], 1.0)


def counts_of_counts(total: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(total, TOP + 2), minlength=TOP + 3).astype(np.int64)


class Unigrams:
    """P(w) from counts of words; stats: N, V and counts of counts."""

    def __init__(self, total: int, types: int, of: np.ndarray):
        self.total, self.types, self.d = total, types, discounts(of)
        if total:
            freed = sum((1 - self.d[r]) * r * float(of[r]) for r in range(1, TOP + 1))
            self.scale = 1.0 if freed > 0 else total / (total + 1.0)
            self.unknown = freed / total if freed > 0 else 1.0 / (total + 1.0)
        else:
            self.scale, self.unknown = 0.0, 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(self.d, counts) * self.scale / max(self.total, 1), self.unknown)


CHUNKS = "chunk long, words binary, tokens binary, rows binary, doc_id binary"


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Texts as numbers of their chunk's dictionary; docs: doc_id, text, held."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        kept: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, kept, size
            words, tokens = np.unique(np.concatenate([x[0] for x in kept]), return_inverse=True)
            ids, n, held = (np.concatenate([x[i] for x in kept]) for i in (1, 2, 3))
            row = [words.tobytes(), packed(tokens.astype("<u4")), packed(n.astype("<u4"), held), ids.tobytes()]
            out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64())] + [pa.array([x], pa.binary()) for x in row], ["chunk", "words", "tokens", "rows", "doc_id"])
            number, kept, size = number + 1, [], 0
            return out

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held = batch.column(2).to_numpy(zero_copy_only=False)
            for low, data, offsets in byte_chunks(batch.column(1)):
                codes, at = word_codes(data, offsets)
                codes = np.insert(codes, at[1:], END)
                high = low + len(offsets) - 1
                kept.append((codes, ids[low:high].astype(np.int64), np.diff(at) + 1, held[low:high].astype(np.uint8)))
                size += len(data)
                if size >= chunk_bytes:
                    yield flush()
        if kept:
            yield flush()

    return docs.mapInArrow(tidied(read), CHUNKS)


class Grams:
    """The distinct n-grams of a chunk for one order.

    ``key`` is sorted: number of the context, then local number of the word.  ``at`` gives
    the n-gram of each token, ``first`` a token of each n-gram, ``owner`` its context among
    the distinct ones, ``starts`` the first n-gram of each context.
    """

    def __init__(self, context: np.ndarray, tokens: np.ndarray, width: int, trained: np.ndarray):
        self.key, self.first, self.at = grouped(context * width + tokens)
        self.counts = np.bincount(self.at[trained], minlength=len(self.key))
        self.context, self.word = np.divmod(self.key, width)
        new = np.ones(len(self.key), bool)
        new[1:] = self.context[1:] != self.context[:-1]
        self.starts = np.flatnonzero(new)
        self.owner = np.cumsum(new) - 1


class Chunk:
    """A chunk with global numbers of its words (``ids``, ascending, the start token first) and their counts."""

    def __init__(self, ids: np.ndarray, totals: np.ndarray, tokens: np.ndarray, n: np.ndarray, held: np.ndarray):
        self.ids, self.totals, self.tokens, self.n = ids, totals, tokens, n
        self.trained = np.repeat(held == 0, n)
        self.last = np.cumsum(n) - 1
        self.begin = self.last - n + 1

    def grams(self, order: int) -> list[Grams]:
        """Distinct n-grams of orders 2 to ``order``; a context is a local word, or an n-gram of the order below (the last number: start tokens alone)."""
        out: list[Grams] = []
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[self.begin] = START
        for k in range(2, order + 1):
            out.append(Grams(context, self.tokens, len(self.ids), self.trained))
            if k < order:
                context = np.empty_like(self.tokens)
                context[1:] = out[-1].at[:-1]
                context[self.begin] = len(out[-1].key)
        return out

    def names(self, grams: list[Grams], order: int) -> list[np.ndarray]:
        """Global numbers of the words of each context of an order, first word first."""
        g = grams[order - 2]
        context = g.context[g.starts]
        if order == 2:
            return [self.ids[context]]
        out = [np.zeros(len(context), np.uint64) for _ in range(order - 1)]
        for k in range(order - 1, 1, -1):  # the last word of each shorter context in turn
            below = grams[k - 2]
            some = context < len(below.key)
            out[k - 1][some] = self.ids[below.word[context[some]]]
            context = np.where(some, below.context[np.minimum(context, len(below.key) - 1)], len(grams[k - 3].key) if k > 2 else START)
        out[0] = self.ids[context]
        return out


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for x in columns:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + x.astype(np.uint64) + np.uint64(1))
    return out


def bucket(codes: np.ndarray, n: int) -> np.ndarray:
    return (codes % np.uint64(n)).astype(np.int64)


def _split(buckets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in their order) of every bucket that has any."""
    order = np.argsort(buckets.astype(np.uint16) if n <= 1 << 16 else buckets, kind="stable")
    edge = np.flatnonzero(np.diff(buckets[order], prepend=-1, append=n))
    for a, b in zip(edge[:-1], edge[1:]):
        yield int(buckets[order[a]]), order[a:b]


def _rows(columns: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[t]) for n, t in fields], [n for n, _ in fields])


ASKED_WORDS = "bucket long, chunk long, asked binary"
#: kind 0: answer to a chunk; 1: statistics of a bucket; 2: part of the statistics of a spread context; 3: a chunk's wish for them.
ANSWERS = "kind int, chunk long, bucket long, key binary, answer binary"


def ask_words(chunked: DataFrame, buckets: int) -> DataFrame:
    """A chunk's words with what its training texts count, by bucket of the word."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, words, tokens, rows = (batch.column(c)[i] for c in range(4))
                words, (tokens,), (n, held) = np.frombuffer(words.as_buffer(), np.uint64), unpacked(tokens.as_buffer(), "<u4"), unpacked(rows.as_buffer(), "<u4", "u1")
                counts = np.bincount(tokens[np.repeat(held == 0, n)], minlength=len(words))
                for b, some in _split(bucket(words, buckets), buckets):
                    yield _rows({"bucket": [b], "chunk": [chunk.as_py()], "asked": [np.array([len(some)], "<u8").tobytes() + words[some].tobytes() + packed(counts[some].astype("<u4"))]}, ASKED_WORDS)

    return chunked.select("chunk", "words", "tokens", "rows").mapInArrow(tidied(ask), ASKED_WORDS)


def answer_words(asked: DataFrame, buckets: int) -> DataFrame:
    """Numbers and totals of the words asked for; what the bucket adds to N, V, counts of counts and the count of the end token."""

    def answer(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        words, counts = [], []
        for x in group["asked"].combine_chunks():
            blob = x.as_buffer()
            n = int(np.frombuffer(blob, "<u8", 1)[0])
            words.append(np.frombuffer(blob, np.uint64, n, 8))
            counts.append(unpacked(blob[8 * n + 8 :], "<u4")[0])
        sizes = [len(w) for w in words]
        known, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(known)).astype(np.int64)
        rank = np.empty(len(known), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(known))
        b = group["bucket"][0].as_py()
        number = (rank * buckets + b + 1).astype("<u8")
        cuts = np.cumsum(sizes)[:-1]
        ends = int(total[known == END].sum())
        stats = np.concatenate([[total.sum(), (total > 0).sum()], counts_of_counts(total), [ends]]).astype(np.int64)
        return _rows(
            {
                "kind": [0] * len(sizes) + [1],
                "chunk": group["chunk"].to_pylist() + [None],
                "bucket": [b] * (len(sizes) + 1),
                "key": [None] * (len(sizes) + 1),
                "answer": [packed(x, y.astype("<u8")) for x, y in zip(np.split(number[at], cuts), np.split(total[at], cuts))] + [stats.tobytes()],
            },
            ANSWERS,
        )

    return asked.groupBy("bucket").applyInArrow(lambda t: done(pa.Table.from_batches([answer(t)])), ANSWERS)


def _stats(answers: DataFrame, width: int) -> np.ndarray:
    """Sum of the statistics of all buckets, position by position, so that only ``width`` rows come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["at", "n"])

    rows = answers.filter("kind = 1").select("answer").mapInArrow(tidied(add), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(width, np.int64)
    out[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return out


def ordered(answers: DataFrame, name: str) -> DataFrame:
    """(chunk, answers by bucket): one row for each chunk."""
    return answers.filter("kind = 0").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias(name))


NUMBERED = "chunk long, ids binary, tokens binary, rows binary, doc_id binary"


def numbered(joined: DataFrame, buckets: int, starts: int) -> DataFrame:
    """Chunks with global numbers in place of words; local numbers follow them, so frequent words are small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, words, tokens, rows, doc_id, answers = (batch.column(c)[i] for c in range(6))
                words, (tokens,) = np.frombuffer(words.as_buffer(), np.uint64), unpacked(tokens.as_buffer(), "<u4")
                ids, totals = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
                for (_, some), got in zip(_split(bucket(words, buckets), buckets), answers.values.field("answer"), strict=True):
                    ids[some], totals[some] = unpacked(got.as_buffer(), "<u8", "<u8")
                order = np.argsort(ids)
                local = np.empty(len(ids), np.int64)
                local[order] = np.arange(1, len(ids) + 1)
                head = np.zeros(1, np.uint64)
                blob = packed(np.diff(np.concatenate([head, ids[order]]), prepend=head).astype("<u8"), np.concatenate([head + np.uint64(starts), totals[order]]).astype("<u8"))
                yield _rows({"chunk": [chunk.as_py()], "ids": [blob], "tokens": [packed(local[tokens].astype("<u4"))], "rows": [rows.as_py()], "doc_id": [doc_id.as_py()]}, NUMBERED)

    return joined.select("chunk", "words", "tokens", "rows", "doc_id", "answers").mapInArrow(tidied(run), NUMBERED)


def _chunk(ids: pa.Scalar, tokens: pa.Scalar, rows: pa.Scalar) -> Chunk:
    (step, totals), (local,), (n, held) = unpacked(ids.as_buffer(), "<u8", "<u8"), unpacked(tokens.as_buffer(), "<u4"), unpacked(rows.as_buffer(), "<u4", "u1")
    return Chunk(np.cumsum(step), totals.astype(np.int64), local.astype(np.int64), n.astype(np.int64), held)


class Dealer:
    """Which bucket answers for each n-gram of a chunk."""

    def __init__(self, chunk: Chunk, grams: list[Grams], order: int, context_totals: np.ndarray, buckets: int, most: int):
        g = grams[order - 2]
        self.names = chunk.names(grams, order)
        spread = (context_totals // most).astype(np.uint64) + np.uint64(1)
        self.hot = spread > 1
        word = mix(chunk.ids[g.word] + np.uint64(77)) % spread[g.owner]
        self.buckets = bucket(mix(_mixed(self.names)[g.owner] + word), buckets)


def context_totals(chunk: Chunk, grams: list[Grams], order: int, below: np.ndarray) -> np.ndarray:
    """Training count of each distinct context of an order; below: totals of the n-grams of the order below (or of words)."""
    g = grams[order - 2]
    context = g.context[g.starts]
    if order == 2:
        return chunk.totals[context]
    return np.append(below, chunk.totals[START])[context]


def put_together(chunk: Chunk, grams: list[Grams], order: int, below: np.ndarray, answers: pa.Scalar, buckets: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(totals of the n-grams, whether a context has statistics, counts of counts, mass, names of the contexts)."""
    g = grams[order - 2]
    dealer = Dealer(chunk, grams, order, context_totals(chunk, grams, order, below), buckets, most)
    totals = np.zeros(len(g.key), np.int64)
    have, of, mass = np.zeros(len(g.starts), bool), np.zeros((len(g.starts), TOP + 1), np.int64), np.zeros(len(g.starts))
    for (_, some), got in zip(_split(dealer.buckets, buckets), answers.values.field("answer"), strict=True):
        total, which, counts, m = unpacked(got.as_buffer(), "<u8", "<u4", "<u4", "<f8")
        totals[some] = total
        owner = g.owner[some]
        mine = owner[np.flatnonzero(np.diff(owner, prepend=-1))[which]]
        have[mine], mass[mine] = True, m
        of[mine, 1:] = counts.reshape(TOP, -1).T
    return totals, have, of, mass, dealer.names


def ask_grams(joined: DataFrame, order: int, limits: list[int], most: int) -> DataFrame:
    """A chunk's distinct n-grams, by bucket, with their training counts and those of the n-grams below; limits: buckets of each order."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column(0)[i].as_py()
                chunk = _chunk(*(batch.column(c)[i] for c in (1, 2, 3)))
                grams = chunk.grams(order)
                below = chunk.totals
                for k in range(2, order):
                    below = put_together(chunk, grams, k, below, batch.column(2 + k)[i], limits[k], most)[0]
                g = grams[-1]
                dealer = Dealer(chunk, grams, order, context_totals(chunk, grams, order, below), limits[order], most)
                shorter = below[chunk.tokens[g.first]] if order == 2 else below[grams[-2].at[g.first]]
                for b, some in _split(dealer.buckets, limits[order]):
                    owner = g.owner[some]
                    edge = np.flatnonzero(np.diff(owner, prepend=-1))
                    mine, n = owner[edge], np.diff(np.append(edge, len(owner)))
                    # a context's first word follows the order of the contexts, so its steps are small
                    names = [np.diff(dealer.names[0][mine].astype(np.int64), prepend=0).astype("<i8"), *(x[mine].astype("<u8") for x in dealer.names[1:])]
                    yield _rows({"bucket": [b], "chunk": [number], "asked": [packed(*names, n.astype("<u4"), dealer.hot[mine].astype("u1"), chunk.ids[g.word[some]].astype("<u8"), g.counts[some].astype("<u4"), shorter[some].astype("<u8"))]}, ASKED_WORDS)

    return joined.mapInArrow(tidied(ask), ASKED_WORDS)


def answer_grams(asked: DataFrame, order: int, weight) -> DataFrame:
    """Totals of the n-grams asked for, and statistics of contexts where one of them is unseen or above TOP.

    weight(counts): what seen n-grams of the order below take of their context's mass, but
    for its total.
    """
    names = order - 1

    def answer(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        parts = [unpacked(x.as_buffer(), "<i8", *["<u8"] * (names - 1), "<u4", "u1", "<u8", "<u4", "<u8") for x in group["asked"].combine_chunks()]
        b, chunks_ = group["bucket"][0].as_py(), group["chunk"].to_pylist()
        columns = [np.concatenate([np.cumsum(p[0]) for p in parts]), *(np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(1, names))]
        n, hot = (np.concatenate([p[names + k] for p in parts]) for k in (0, 1))
        words, counts, below = (np.concatenate([p[names + k] for p in parts]).astype(np.int64) for k in (2, 3, 4))
        sizes = [len(p[names]) for p in parts]
        entries = [len(p[names + 2]) for p in parts]
        del parts
        # distinct contexts, then distinct n-grams
        _, one_context, which = grouped(joint(columns))
        context = np.repeat(which, n)
        _, one, gram = grouped(joint([context, words]))
        owner, below = context[one], below[one]
        del words, context
        total = np.bincount(gram, counts).astype(np.int64)
        seen = total > 0
        low = seen & (total <= TOP)
        of = np.bincount(owner[low] * (TOP + 1) + total[low], minlength=len(one_context) * (TOP + 1)).reshape(-1, TOP + 1)
        mass = np.bincount(owner[seen], weight(below[seen]), len(one_context))
        out = {"kind": [], "chunk": [], "bucket": [], "key": [], "answer": []}

        def put(kind: int, chunk: int | None, key: bytes | None, answer: bytes | None) -> None:
            for name, x in zip(out, (kind, chunk, b, key, answer)):
                out[name].append(x)

        key = lambda c: np.array([x[c] for x in columns], "<i8").tobytes()
        a = e = 0
        for chunk, size, m in zip(chunks_, sizes, entries):
            mine, some = which[a : a + size], total[gram[e : e + m]]
            need = np.zeros(size, bool)
            need[np.repeat(np.arange(size), n[a : a + size])[(some == 0) | (some > TOP)]] = True
            spread = hot[a : a + size] > 0
            for c in np.flatnonzero(need & spread).tolist():
                put(3, chunk, key(a + c), None)
            need = np.flatnonzero(need & ~spread)
            put(0, chunk, None, packed(some.astype("<u8"), need.astype("<u4"), of[mine[need], 1:].T.astype("<u4").ravel(), mass[mine[need]].astype("<f8")))
            a, e = a + size, e + m
        for c in one_context[hot[one_context] > 0].tolist():
            put(2, None, key(c), of[which[c], 1:].astype("<f8").tobytes() + np.array([mass[which[c]]]).tobytes())
        put(1, None, None, counts_of_counts(total).tobytes())
        return pa.Table.from_batches([_rows(out, ANSWERS)])

    return asked.groupBy("bucket").applyInArrow(lambda t: done(answer(t)), ANSWERS)


def spread_statistics(answers: DataFrame, name: str) -> DataFrame:
    """(chunk, wishes answered): statistics of spread contexts, added up over their partitions."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([np.frombuffer(x.as_buffer(), "<f8") for x in batch.column(1)]).reshape(-1, TOP + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(values[:, i])) for i in range(TOP + 1))], ["key", *(f"s{i}" for i in range(TOP + 1))])

    parts = answers.filter("kind = 2").select("key", "answer").mapInArrow(tidied(read), "key binary, " + ", ".join(f"s{i} double" for i in range(TOP + 1)))
    sums = parts.groupBy("key").agg(F.array(*[F.sum(f"s{i}") for i in range(TOP + 1)]).alias("s"))
    wishes = answers.filter("kind = 3").select("chunk", "key").distinct()
    return wishes.join(sums, "key").groupBy("chunk").agg(F.collect_list(F.struct("key", "s")).alias(name))


def evaluate(d: np.ndarray, total: np.ndarray, count: np.ndarray, freed: np.ndarray, mass: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """P(w | h) from totals of n-grams, the count, freed count and lower-order mass of their contexts, and P(w | h')."""
    n = np.where(freed > 0, count, count + 1)
    rest = np.maximum(1 - mass, 1e-300)
    backoff = np.where(count > 0, np.where(freed > 0, freed, 1.0) / np.maximum(n, 1) / rest, 1.0)
    return np.where(total > 0, discounted(d, total) / np.maximum(n, 1), backoff * lower)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_chunks(joined: DataFrame, order: int, limits: list[int], most: int, unigrams: Unigrams, d: list[np.ndarray]) -> DataFrame:
    """Scores of every text; joined: chunks with the answers of each order, then what was added up for spread contexts."""
    size, types = unigrams.total, unigrams.types

    def spread(answers: pa.Scalar, names: list[np.ndarray], have: np.ndarray, of: np.ndarray, mass: np.ndarray) -> None:
        if not answers.is_valid:
            return
        keys, sums = answers.values.field("key"), np.asarray(answers.values.field("s").flatten()).reshape(-1, TOP + 1)
        place = {k.as_py(): i for i, k in enumerate(keys)}
        # Spread contexts are few; only their words are looked at.
        some = np.isin(names[-1].astype(np.int64), [np.frombuffer(k, "<i8")[-1] for k in place])
        for c in np.flatnonzero(some).tolist():
            i = place.get(np.array([x[c] for x in names], "<i8").tobytes())
            if i is not None:
                have[c], of[c, 1:], mass[c] = True, sums[i, :TOP].astype(np.int64), sums[i, TOP]

    def one(row: list[pa.Scalar]) -> pa.RecordBatch:
        chunk = _chunk(*row[1:4])
        grams = chunk.grams(order)
        p = unigrams.p(chunk.totals)[chunk.tokens]
        below, below_d, below_n = chunk.totals, unigrams.d, None
        for k in range(2, order + 1):
            g = grams[k - 2]
            count = context_totals(chunk, grams, k, below)
            total, have, of, mass, names = put_together(chunk, grams, k, below, row[3 + k - 1], limits[k], most)
            spread(row[3 + order - 1 + k - 1], names, have, of, mass)
            freed = sum((1 - d[k][r]) * r * of[:, r] for r in range(1, TOP + 1))
            # A context without statistics has a seen n-gram of a discounted count, so it frees something.
            freed = np.where(have, freed, 1.0)
            if k == 2:
                share = mass * unigrams.scale / max(size, 1)
            else:
                # of a context's mass in the order below, whose context is the same without its first word
                shorter = grams[k - 3].owner[grams[k - 3].at[g.first[g.starts]]]
                share = mass / np.maximum(below_n[shorter], 1)
            p = evaluate(d[k], total[g.at], count[g.owner[g.at]], freed[g.owner[g.at]], share[g.owner[g.at]], p)
            below, below_n = total, np.where(freed > 0, count, count + 1)
        word = chunk.totals
        base = np.log10((word + ADD) / (size + ADD * (types + 1)))[chunk.tokens]
        sums = lambda x: pa.array(np.add.reduceat(x, chunk.begin) if len(chunk.begin) else x)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.frombuffer(row[-1].as_buffer(), np.int64)),
                pa.array(unpacked(row[3].as_buffer(), "<u4", "u1")[1] > 0),
                pa.array(chunk.n),
                sums((word > 0)[chunk.tokens].astype(np.int64)),
                pa.array(np.full(len(chunk.n), size, np.int64)),
                sums(base),
                sums(np.log10(p)),
            ],
            [f.split()[0] for f in SCORES.split(", ")],
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield one([batch.column(c)[i] for c in range(batch.num_columns)])

    return joined.mapInArrow(tidied(score), SCORES)


def scores(docs: DataFrame, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES, task_entries: int = TASK_ENTRIES) -> DataFrame:
    """Scores of all rows of docs (doc_id, text, held); those not held are learned from."""
    scratch = Scratch(docs.sparkSession, "katz")
    chunked = scratch.put(chunks(docs, chunk_bytes), "chunks")
    sizes = chunked.agg(F.sum(F.octet_length("words")) / 8, F.count("*")).first()
    buckets = max(1, math.ceil(int(sizes[0] or 0) / task_entries))
    most = max(1, task_entries // SPREAD)
    first = scratch.put(answer_words(ask_words(chunked, buckets), buckets), "words")
    stats = _stats(first, TOP + 6)
    unigrams = Unigrams(int(stats[0]), int(stats[1]), stats[2:-1])
    known = scratch.put(numbered(chunked.join(ordered(first, "answers"), "chunk"), buckets, int(stats[-1])), "known")
    scratch.drop("chunks")
    scratch.drop("words")
    scratch.tidy()
    # No table of n-grams is larger than the training tokens; about so many are distinct in a chunk.
    tokens = int(stats[0])
    limits = [0, 0] + [max(1, math.ceil((0.5 + 0.15 * k) * tokens / task_entries)) for k in range(2, order + 1)]
    d, joined, answered = [unigrams.d, unigrams.d], known, []
    for k in range(2, order + 1):
        below = d[k - 1]
        weight = lambda counts, below=below: discounted(below, counts)
        answers = scratch.put(answer_grams(ask_grams(joined.drop("doc_id") if k == 2 else joined.select("chunk", "ids", "tokens", "rows", *[f"answers{i}" for i in range(2, k)]), k, limits, most), k, weight), f"order{k}")
        scratch.tidy()
        d.append(discounts(_stats(answers, TOP + 3)))
        answered.append(answers)
        if k < order:
            joined = joined.join(ordered(answers, f"answers{k}"), "chunk")
    out = known
    for k, answers in enumerate(answered, 2):
        out = out.join(ordered(answers, f"answers{k}"), "chunk")
    for k, answers in enumerate(answered, 2):
        out = out.join(spread_statistics(answers, f"spread{k}"), "chunk", "left")
    names = [f"{x}{k}" for x in ("answers", "spread") for k in range(2, order + 1)]
    return score_chunks(out.select("chunk", "ids", "tokens", "rows", *names, "doc_id"), order, limits, most, unigrams, d)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from all documents but a tenth, chosen by the id's checksum."""
    docs = table(spark, sf_dir, "documents").filter("doc_id is not null")
    return scores(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (crc_of_id() % 10 == 0).alias("held")))
