"""Byte-level BPE by a tokenization automaton: encoding and decoding.

The merges are compiled into a deterministic automaton over tokens that accepts just the
correct tokenizations.  It begins as one state where every byte may follow every byte.
Each merge (u, v) in turn is a gadget: wherever u and then v can be read, an arc for uv
is added past both, and the state behind u is copied without its arc for v.  A state is
thus a chain of removals (token, merge that removed it), and an arc exists unless its
token, or one that the token begins with and that was still free then, was removed.

Words are split before, as the tokenizer splits them.  Every beginning of a word has one
correct tokenization, so exactly one arc enters each place: a word is encoded by going
from place to place through the tables.  Decoding emits the bytes that label the arcs.

Null text is the empty text, without ids.  Rows that repeat an id are rows of their own;
a null id stays null.  An empty table gives no rows.  Other columns are ignored.  Very
long texts are split by and by; their ids are held by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, tidied

#: How the public byte-level tokenizers split words; white space as Unicode has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER, NUMBER = r"\p{L}", r"\p{N}"


def piece_pattern(letter: str = LETTER, number: str = NUMBER) -> str:
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


#: Pieces whose ids a worker keeps before it starts anew, and pieces that are looked up at once.
CACHED_PIECES, AT_ONCE = 400_000, 500_000
#: Pieces of more bytes are encoded one by one.
LONG = 200
NEVER = np.int32(2**31 - 1)

ENCODED = "doc_id long, n_tokens long, ids binary"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies spell bytes: printable ones stand for themselves, the rest follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Gadgets:
    """The automaton while merges are added: states as chains of removals."""

    def __init__(self, n_tokens: int):
        self.behind = np.zeros(n_tokens, np.int64)  # the state that arcs of a token lead to
        self.copied, self.removed, self.at = [-1], [-1], [-1]
        self.left, self.made = np.full(n_tokens, -1, np.int64), np.full(n_tokens, NEVER, np.int64)

    def lookup(self, state: int, token: int) -> int | None:
        """When a token's own arc was removed from a state."""
        while state:
            if self.removed[state] == token:
                return self.at[state]
            state = self.copied[state]
        return None

    def arc(self, state: int, token: int) -> bool:
        limit = int(NEVER)
        while token >= 0:
            gone = self.lookup(state, token)
            if gone is not None and gone <= limit:
                return False
            limit, token = int(self.made[token]), int(self.left[token])
        return True

    def add(self, rank: int, u: int, v: int, uv: int) -> None:
        state = int(self.behind[u])
        if self.left[uv] >= 0:
            raise ValueError("a token that two merges make")
        if not self.arc(state, v):
            return  # never read in this order
        # uv leads to where v led so far; behind u is from now on a state without v.
        self.behind[uv], self.left[uv], self.made[uv] = self.behind[v], u, rank
        self.copied.append(state)
        self.removed.append(v)
        self.at.append(rank)
        self.behind[u] = len(self.copied) - 1


class Automaton:
    """Tables of a compiled vocabulary.  Their size is that of the vocabulary, whatever the corpus."""

    def __init__(self, spec: dict[str, Any], newer: str = ""):
        self.newer = newer
        model, letters = spec["model"], byte_letters()
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = 1 + max([*vocab.values(), *self.special.values()])
        gadgets = Gadgets(n)
        for rank, merge in enumerate(model["merges"]):
            u, v = merge if isinstance(merge, list) else merge.split(" ")
            gadgets.add(rank, vocab[u], vocab[v], vocab[u + v])
        labels = [b""] * n
        for token, i in vocab.items():
            labels[i] = bytes(letters[c] for c in token) if i not in self.special.values() else b""
        live = [i for i in vocab.values() if labels[i] and (len(labels[i]) == 1 or gadgets.left[i] >= 0)]
        for token, i in self.special.items():
            labels[i] = token.encode()
        # Labels of arcs, end to end.
        self.label_at = np.concatenate([[0], np.cumsum([len(x) for x in labels])])
        self.label = np.frombuffer(b"".join(labels), np.uint8)
        self.left, self.made = gadgets.left.astype(np.int32), gadgets.made.astype(np.int32)
        # Only states that arcs lead to are left; their removals as sorted keys (state, token).
        states, self.behind = np.unique(np.append(gadgets.behind, 0), return_inverse=True)
        self.behind, self.start, self.n = self.behind[:-1].astype(np.int32), int(self.behind[-1]), n
        keys, at = [], []
        for number, state in enumerate(states.tolist()):
            while state:
                keys.append(number * n + gadgets.removed[state])
                at.append(gadgets.at[state])
                state = gadgets.copied[state]
        order = np.argsort(keys)
        self.keys, self.at = np.asarray(keys, np.int64)[order], np.asarray(at, np.int32)[order]
        self._paths(labels, live)
        self._index()

    def _paths(self, labels: list[bytes], live: list[int]) -> None:
        """Which bytes lead on from a place inside a label, and which token ends there."""
        step: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in live:
            node = 0
            for b in labels[i]:
                if (node, b) not in step:
                    step[node, b] = len(ends)
                    ends.append(-1)
                node = step[node, b]
            ends[node] = i
        self.ends = np.asarray(ends, np.int32)
        pairs = sorted((node * 256 + b, to) for (node, b), to in step.items())
        self.step_keys, self.step_to = (np.asarray(x) for x in zip(*pairs))

    BITS = 24

    def _index(self) -> None:
        """Bits that tell most absent keys at once."""
        self.maybe, self.may_step = np.zeros(1 << self.BITS, bool), np.zeros(1 << self.BITS, bool)
        self.maybe[self._bit(self.keys)] = True
        self.may_step[self._bit(self.step_keys)] = True

    def _bit(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def _find(self, table: np.ndarray, maybe: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are there, where)."""
        likely = np.flatnonzero(maybe[self._bit(keys)])
        where = np.minimum(np.searchsorted(table, keys[likely]), len(table) - 1)
        hit = table[where] == keys[likely]
        return likely[hit], where[hit]

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether a state has an arc for a token."""
        free = np.ones(len(state), bool)
        some, base, x = np.arange(len(state)), state.astype(np.int64) * self.n, token.astype(np.int64)
        limit = np.full(len(state), NEVER)
        while len(some):
            hit, where = self._find(self.keys, self.maybe, base + x)
            gone = hit[self.at[where] <= limit[hit]]
            free[some[gone]] = False
            limit, x = self.made[x], self.left[x].astype(np.int64)
            on = x >= 0
            on[gone] = False
            some, base, x, limit = some[on], base[on], x[on], limit[on]
        return free

    def encode_words(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all words, tokens before each) of the words data[at[i]:at[i + 1]]."""
        n, size = len(data), np.diff(at)
        end, offset = np.repeat(at[1:], size), np.arange(n) - np.repeat(at[:-1], size)
        begins, tokens, lengths = [], [], []
        place, node, depth = np.arange(n), np.zeros(n, np.int64), 0
        while len(place):
            hit, where = self._find(self.step_keys, self.may_step, node * 256 + data[place + depth])
            place, node, depth = place[hit], self.step_to[where], depth + 1
            full = self.ends[node] >= 0
            begins.append(place[full])
            tokens.append(self.ends[node[full]])
            lengths.append(np.full(int(full.sum()), depth))
            more = place + depth < end[place]
            place, node = place[more], node[more]
        begin, token, length = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (begins, tokens, lengths))
        # Arcs by the place inside their word: states there are known when they are reached.
        order = np.argsort(offset[begin], kind="stable")
        begin, token, length = begin[order], token[order], length[order]
        cuts = np.searchsorted(offset[begin], np.arange(int(size.max(initial=0)) + 1))
        # Places are numbered so that every word has one more than it has bytes.
        shift = np.repeat(np.arange(len(size)), size)
        state, into, back = (np.zeros(n + len(size), np.int64) for _ in range(3))
        state[at[:-1] + np.arange(len(size))] = self.start
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            here = begin[low:high] + shift[begin[low:high]]
            ok = np.flatnonzero(self.arcs(state[here], token[low:high]))
            to = here[ok] + length[low:high][ok]
            state[to], into[to], back[to] = self.behind[token[low:high][ok]], token[low:high][ok], here[ok]
        # Back from the ends of the words, one token of each at a time.
        word, first = np.arange(len(size)), at[:-1] + np.arange(len(size))
        here, found, whose = at[1:] + word, [], []
        some = here > first
        word, here = word[some], here[some]
        while len(word):
            found.append(into[here])
            whose.append(word)
            here = back[here]
            some = here > first[word]
            word, here = word[some], here[some]
        found, whose = np.concatenate([*found, np.zeros(0, np.int64)]), np.concatenate([*whose, np.zeros(0, np.int64)])
        order = np.argsort(whose[::-1], kind="stable")
        count = np.bincount(whose, minlength=len(size))
        return found[::-1][order].astype(np.uint32), np.concatenate([[0], np.cumsum(count)])

    @property
    def rows(self) -> tuple[dict[int, int], dict[int, int]]:
        """The same tables for words that are taken one by one."""
        if not hasattr(self, "_rows"):
            self._rows = dict(zip(self.step_keys.tolist(), self.step_to.tolist())), dict(zip(self.keys.tolist(), self.at.tolist()))
        return self._rows

    def encode_long(self, word: bytes) -> np.ndarray:
        """Tokens of one word, however long."""
        step, gone = self.rows
        ends, behind, left, made = self.ends, self.behind, self.left, self.made
        state, into = np.full(len(word) + 1, -1, np.int32), np.zeros(len(word) + 1, np.int32)
        state[0] = self.start
        for i in range(len(word)):
            node, base = 0, int(state[i]) * self.n
            for j in range(i, len(word)):
                node = step.get(node * 256 + word[j])
                if node is None:
                    break
                token = x = int(ends[node])
                limit = int(NEVER)
                while x >= 0 and gone.get(base + x, limit + 1) > limit:
                    limit, x = int(made[x]), int(left[x])
                if token >= 0 and x < 0:
                    state[j + 1], into[j + 1] = behind[token], token
        out, i = [], len(word)
        while i:
            out.append(int(into[i]))
            i -= int(self.label_at[out[-1] + 1] - self.label_at[out[-1]])
        return np.asarray(out[::-1], np.uint32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(labels of all ids end to end, where each begins)."""
        size = self.label_at[ids + 1] - self.label_at[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.label[np.repeat(self.label_at[ids] - total[:-1], size) + np.arange(total[-1])], total


class Encoder:
    """Ids of whole texts.  Distinct new pieces are encoded together; their ids stay in one pool."""

    def __init__(self, automaton: Automaton):
        import regex

        self.automaton = automaton
        self.usual = regex.compile(piece_pattern())
        # Where characters occur that only the pattern library counts as letters or numbers, another pattern leaves them out.
        self.newer, newer = set(automaton.newer), "".join(f"\\U{ord(c):08X}" for c in automaton.newer)
        self.other = regex.compile(piece_pattern(rf"[{LETTER}--[{newer}]]", rf"[{NUMBER}--[{newer}]]"), regex.V1) if newer else None
        self.parts = regex.compile("|".join(map(regex.escape, sorted(automaton.special, key=len, reverse=True)))).split if automaton.special else None
        self.marks = regex.compile("|".join(map(regex.escape, sorted(automaton.special, key=len, reverse=True)))).findall if automaton.special else None
        self._forget()

    def _forget(self) -> None:
        self.number = {}
        self.pool, self.at = [], np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        for token, i in self.automaton.special.items():
            self.number["\0special", token] = len(self.number)
            self._keep(np.asarray([i], np.uint32), np.asarray([0, 1]))

    def _keep(self, ids: np.ndarray, at: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, ids])
        self.at = np.concatenate([self.at, self.at[-1] + at[1:]])

    def _learn(self, pieces: list[str]) -> None:
        new = list({p for p in pieces if p not in self.number})
        data = [p.encode() for p in new]
        short = [i for i, d in enumerate(data) if len(d) <= LONG]
        long = [i for i, d in enumerate(data) if len(d) > LONG]
        at = np.concatenate([[0], np.cumsum([len(data[i]) for i in short])]).astype(np.int64)
        self._keep(*self.automaton.encode_words(np.frombuffer(b"".join(data[i] for i in short), np.uint8).astype(np.int64), at))
        for i in long:
            ids = self.automaton.encode_long(data[i])
            self._keep(ids, np.asarray([0, len(ids)]))
        begin = len(self.number)
        self.number.update((new[i], begin + k) for k, i in enumerate(chain(short, long)))

    def _pieces(self, text: str) -> Iterator[list]:
        """Pieces of a text, so many at once."""
        if self.parts and self.marks(text):
            marks = self.marks(text)
            for k, part in enumerate(self.parts(text)):
                yield from self._plain(part)
                if k < len(marks):
                    yield [("\0special", marks[k])]
        else:
            yield from self._plain(text)

    def _plain(self, text: str) -> Iterator[list]:
        pattern = self.other if self.newer and not text.isascii() and not self.newer.isdisjoint(text) else self.usual
        if len(text) <= AT_ONCE:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while some := [m.group() for m in islice(found, AT_ONCE)]:
            yield some

    def _ids(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many before each)."""
        if len(self.number) > CACHED_PIECES:
            self._forget()
        try:
            which = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        except KeyError:
            self._learn([p for p in pieces if isinstance(p, str)])
            which = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        size = self.at[which + 1] - self.at[which]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(self.at[which] - total[:-1], size) + np.arange(total[-1])], total

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, ids before each of its texts) of runs of texts."""
        low, pieces, ends = 0, [], [0]
        for i, text in enumerate(texts):
            parts = self._pieces(text) if text else iter(())
            first = next(parts, [])
            pieces += first
            second = next(parts, None)
            if second is not None:  # a long text, or one with special tokens
                mine = [self._ids(x)[0] for x in chain([pieces[ends[-1] :], second], parts)]
                if len(ends) > 1:
                    ids, total = self._ids(pieces[: ends[-1]])
                    yield low, ids, total[ends]
                ids = np.concatenate(mine)
                yield i, ids, np.asarray([0, len(ids)])
                low, pieces, ends = i + 1, [], [0]
                continue
            ends.append(len(pieces))
            if len(pieces) > AT_ONCE:
                ids, total = self._ids(pieces)
                yield low, ids, total[ends]
                low, pieces, ends = i + 1, [], [0]
        if len(ends) > 1:
            ids, total = self._ids(pieces)
            yield low, ids, total[ends]


_MADE: dict[str, Encoder] = {}


def _encoder(tables: Broadcast, name: str) -> Encoder:
    """One for all tasks of a worker process, so that what is known stays known."""
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = Encoder(tables.value)
    return _MADE[name]


def newer_letters(path: str) -> str:
    """Characters that the pattern library counts as letters or numbers, but the tokenizer, which follows an older Unicode, does not."""
    import regex
    from tokenizers import Tokenizer

    split, out = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str, []
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for beside, kind in (("a", LETTER), ("1", NUMBER)):
        some = regex.findall(kind, every)
        # A letter beside a letter, or a number beside a number, is one piece with it.
        joined = {low for _, (low, high) in split("\n".join(beside + c for c in some)) if high - low == 2}
        out += [c for i, c in enumerate(some) if 3 * i not in joined]
    return "".join(out)


@lru_cache(2)
def compiled(path: str) -> Automaton:
    import json

    with open(path, encoding="utf-8") as f:
        return Automaton(json.load(f), newer_letters(path))


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of an array of numbers as binary values."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at * data.itemsize, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of whole texts, little-endian unsigned 32-bit."""
    sent = docs.sparkSession.sparkContext.broadcast(compiled(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent, tokenizer_path)
        for batch in batches:
            for low, ids, at in encoder.encode(batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(at) - 1), pa.array(np.diff(at), pa.int64()), _binary(ids.astype("<u4"), at)], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), ENCODED)


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that its ids stand for; special tokens are spelt out."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    sent, column = encoded.sparkSession.sparkContext.broadcast(compiled(tokenizer_path)), encoded.columns.index(ids)
    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from llm.textcodes import byte_chunks

        for batch in batches:
            for low, data, at in byte_chunks(batch.column(column), 1 << 20):
                labels, begin = sent.value.decode(data.view("<u4").astype(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.slice(low, len(at) - 1).columns, _binary(labels, begin[at // 4])], schema.names)

    return encoded.mapInArrow(tidied(run), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_tokenizer()
    both = decode(encode(table(spark, sf_dir, "documents"), path), path)
    # Bytes that are no characters, which only odd ids give, become the replacement character.
    text = F.make_valid_utf8(F.col("decoded").cast("string")).cast("binary")
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(text, 256).alias("decoded_sha256"))
