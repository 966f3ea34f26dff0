"""Packing: concatenate all documents and cut the stream into fixed windows.

Two passes.  The first tokenises every document once and stores its ids with the
running total inside its input partition.  The totals of the partitions, one number
each, give every partition its global offset; the second pass adds that offset and
cuts at multiples of the window length.  Each cut is a boundary record: the piece of a
document, where it lies, and its ids.  Only the last window can need padding.

Null text is the empty text, a document of the end id alone.  Rows with a null id are
packed as well, under a null id.  A repeated id is one document for each row.  An
empty table gives no pieces.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import Scratch, table, tidied
from llm.textcodes import byte_chunks, lower, prefix, spans_code, words

SEQUENCE_LENGTH = 2048
END_ID = 1
#: Encodings of so many different words are kept by a worker before it starts anew.
CACHED_WORDS = 500_000
#: Bytes of text, or of ids, that are worked on at once; a longer text is worked on alone.
TEXT_BYTES = 4 << 20

STORED = "part long, local_start long, doc_id long, n long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


@lru_cache(1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """ids of whole texts for the word BPE, whose ids never reach across white space.

    Works on many texts at once: words are coded (64 bits), sorted, and only distinct new
    ones are encoded; their ids lie in one pool, from which every text's are gathered.
    Pieces of a word (a run of letters, a digit, a run of other signs) are found by byte
    classes, or by the tokenizer's own pattern where a word is not plain ASCII.  Pieces end
    with an id of the end-of-word kind, which tells joined encodings apart.  Words above
    ``LONG`` bytes and those that hold a special token are encoded one by one.
    """

    PIECE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    LONG = 64
    JOINED = 512

    def __init__(self, path: str, end_id: int = END_ID):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = t = _tokenizer(path)
        spec = json.loads(t.to_str())
        # Pieces are normalised and split already: only the model is left to run.
        spec |= {"normalizer": None, "added_tokens": [], "post_processor": None}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.model = Tokenizer.from_str(json.dumps(spec))
        self.find = regex.compile(self.PIECE).findall
        self.ends = np.zeros(t.get_vocab_size() + 1, bool)
        self.ends[[i for w, i in t.get_vocab().items() if w.endswith("</w>")]] = True
        self.end_id = end_id
        # What the bytes 0x21 to 0x7E are: 1 letter, 2 digit, 3 sign; 0 is anything else.
        self.kind = np.zeros(256, np.uint8)
        self.kind[0x21:0x7F] = 3
        self.kind[48:58] = 2
        self.kind[65:91] = self.kind[97:123] = 1
        self.kind[ord("'")] = 0  # contractions are left to the pattern
        self._forget()

    def _forget(self) -> None:
        self.codes = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _plain(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[str, np.ndarray]:
        """(pieces of plain words parted by spaces, pieces of each word)."""
        size = end - start
        begin = np.cumsum(size) - size
        at = np.repeat(start - begin, size) + np.arange(size.sum())
        data = low[at]
        kind = self.kind[data]
        first = np.ones(len(data), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        first[begin] = True
        where = np.flatnonzero(first)
        text = np.full(len(data) + len(where), 32, np.uint8)
        text[np.arange(len(data)) + np.cumsum(first)] = data
        return text[1:].tobytes().decode("ascii"), np.diff(np.append(np.searchsorted(where, begin), len(where)))

    def _other(self, words: list[bytes]) -> list[list[str]]:
        """Pieces of words that are not plain; none for those that only the tokenizer itself can take."""
        out: list[list[str]] = []
        normal = self.tokenizer.normalizer.normalize_str
        for low in range(0, len(words), self.JOINED):
            some = [w.decode("utf-8", "replace") for w in words[low : low + self.JOINED]]
            clean = normal(" ".join(some)).split(" ")
            if len(clean) != len(some):
                clean = [normal(w) for w in some]
            out += [[w] if w.isalpha() else self.find(w) for w in clean]
        return out

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each piece)."""
        ids, sizes = [], []
        groups = [pieces[i : i + self.JOINED] for i in range(0, len(pieces), self.JOINED)]
        for some, e in zip(groups, self.model.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            got = np.asarray(e.ids, np.uint32)
            cuts = np.flatnonzero(self.ends[got]) + 1
            if len(cuts) != len(some) or (len(cuts) and cuts[-1] != len(got)):
                each = [np.asarray(self.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32) for x in some]
                got, cuts = np.concatenate([np.zeros(0, np.uint32), *each]), np.cumsum([len(x) for x in each])
            ids.append(got)
            sizes.append(np.diff(cuts, prepend=0))
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _whole(self, words: list[bytes]) -> list[np.ndarray]:
        return [np.asarray(self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32) for w in words]

    def _learn(self, codes: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Encode distinct new words, given by their places."""
        plain_bytes = np.zeros(len(low) + 1, np.int64)
        np.cumsum(self.kind[low] == 0, out=plain_bytes[1:])
        plain = plain_bytes[end] == plain_bytes[start]
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        codes, start, end = codes[order], start[order], end[order]
        k = int(plain.sum())
        text, counts = self._plain(low, start[:k], end[:k]) if k else ("", np.zeros(0, np.int64))
        view = low.tobytes()
        other = self._other([view[a:b] for a, b in zip(start[k:].tolist(), end[k:].tolist())])
        counts = np.concatenate([counts, np.array([len(x) for x in other], np.int64)])
        pieces = (text.split(" ") if k else []) + [p for x in other for p in x]
        distinct = dict.fromkeys(pieces)
        ids, sizes = self._ids(list(distinct))
        place = {p: i for i, p in enumerate(distinct)}
        which = np.fromiter(map(place.__getitem__, pieces), np.int64, len(pieces))
        mine = np.repeat(np.arange(len(codes)), counts)
        word_size = np.bincount(mine, sizes[which], len(codes)).astype(np.int64)
        self._keep(codes, word_size, ids[_ragged((np.cumsum(sizes) - sizes)[which], sizes[which])])

    def _keep(self, codes: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            pool = np.zeros(2 * (self.used + len(ids)), np.uint32)
            pool[: self.used] = self.pool[: self.used]
            self.pool = pool
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        codes, at, size = np.concatenate([self.codes, codes]), np.concatenate([self.at, at]), np.concatenate([self.size, size.astype(np.int32)])
        order = np.argsort(codes, kind="stable")
        self.codes, self.at, self.size = codes[order], at[order], size[order]

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end id; ids before each text)."""
        if len(self.codes) > CACHED_WORDS:
            self._forget()
        start, end, at = words(data, offsets)
        low = lower(data)
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))  # "<|" of special tokens
        alone = end - start > self.LONG
        if len(special):
            alone[np.searchsorted(start, special, "right") - 1] = True
        codes = spans_code(prefix(low), start, end)
        short = np.flatnonzero(~alone)
        distinct, first, inverse = np.unique(codes[short], return_index=True, return_inverse=True)
        where = np.searchsorted(self.codes, distinct)
        new = np.ones(len(distinct), bool)
        inside = where < len(self.codes)
        new[inside] = self.codes[where[inside]] != distinct[inside]
        if new.any():
            one = short[first[new]]
            self._learn(distinct[new], low, start[one], end[one])
            where = np.searchsorted(self.codes, distinct)
        # Words taken alone and end ids follow the pool, for this call only.
        rare = np.flatnonzero(alone)
        single = {w: None for w in (data[start[i] : end[i]].tobytes() for i in rare.tolist())}
        ids = self._whole(list(single))
        number = {w: i for i, w in enumerate(single)}
        extra = np.concatenate([np.array([self.end_id], np.uint32), *ids])
        extra_size = np.array([1, *(len(x) for x in ids)], np.int64)
        extra_at = self.used + np.cumsum(extra_size) - extra_size
        if self.used + len(extra) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(len(extra) + self.used // 2, np.uint32)])
        self.pool[self.used : self.used + len(extra)] = extra
        word_at, word_size = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        word_at[short], word_size[short] = self.at[where][inverse], self.size[where][inverse]
        mine = np.array([1 + number[data[start[i] : end[i]].tobytes()] for i in rare.tolist()], np.int64)
        word_at[rare], word_size[rare] = extra_at[mine], extra_size[mine]
        word_at, word_size = np.insert(word_at, at[1:], extra_at[0]), np.insert(word_size, at[1:], 1)
        total = np.concatenate([[0], np.cumsum(word_size)])
        return self.pool[_ragged(word_at, word_size)], total[at + np.arange(len(at))]


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] to start[0] + size[0] - 1, then those of the next, and so on."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


@lru_cache(1)
def _encoder(path: str, end_id: int) -> WordEncoder:
    """One for all tasks of a worker process: what is known stays known."""
    return WordEncoder(path, end_id)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of an array of numbers as binary values, without a copy of each."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets * data.itemsize, np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """The first pass: ids of each document and where it starts in its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, at = _encoder(tokenizer_path, end_id), TaskContext.get().partitionId(), 0
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1), TEXT_BYTES):
                ids, begin = encoder.encode_texts(data, offsets)
                rows = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, part, np.int64)), pa.array(at + begin[:-1]), batch.column(0).slice(low, rows), pa.array(np.diff(begin)), _binary(ids.astype("<u4"), begin)],
                    ["part", "local_start", "doc_id", "n", "ids"],
                )
                at += len(ids)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(encode), STORED)


def cut(stored: DataFrame, offsets: np.ndarray, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """The second pass: pieces at global offsets (one for each partition of the first pass), cut at multiples of ``length``."""
    sent = stored.sparkSession.sparkContext.broadcast(offsets)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, local, n = (batch.column(i).to_numpy() for i in (0, 1, 3))
            for low, data, _ in byte_chunks(batch.column(4), TEXT_BYTES):
                # ids of neighbouring rows lie end to end, and so do their pieces
                ids, high = data.view("<u4"), low
                while high < batch.num_rows and n[low : high + 1].sum() <= len(ids):
                    high += 1
                size = n[low:high]
                at = local[low:high] + sent.value[part[low:high]]
                count = (at + size - 1) // length - at // length + 1
                row = np.repeat(np.arange(len(size)), count)
                k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = np.maximum((at[row] // length + k) * length, at[row])
                end = np.minimum((at[row] // length + k + 1) * length, at[row] + size[row])
                first = begin - at[row]
                bounds = np.append((np.cumsum(size) - size)[row] + first, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(low, high - low).take(pa.array(row)), *map(pa.array, (first, end - begin, size[row], begin // length, begin % length)), _binary(ids, bounds)],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return stored.mapInArrow(tidied(pieces), PIECES)


def pack(docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE_LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    stored = Scratch(spark, "packing").put(tokenized(docs, tokenizer_path, end_id), "ids")
    # One number for each partition of the input: it grows with files, not with rows.
    totals = stored.groupBy("part").agg(F.sum("n").alias("n")).toArrow()
    part, n = (totals[c].to_numpy() for c in ("part", "n"))
    sizes = np.zeros(int(part.max()) + 1 if len(part) else 0, np.int64)
    sizes[part] = n
    return cut(stored, np.cumsum(sizes) - sizes, length)


def with_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(pack(table(spark, sf_dir, "documents"), default_tokenizer()))
