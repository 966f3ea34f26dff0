import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm import automata

PARTS = [*"abcXYZ019'`-_.,;:<>|!? \t\n\x0b\x1c\x1f\x00", "  ", "the", "ing", "\x85", "\xa0", "é", "ß", "İ", "世", "界", "🙂", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "<|", "Ⅷ", "²", "　", "​", "՘", "\U000323b0", "aaaa", "----", "\n\n"]
ODD = ["", None, "a" * 500, "-" * 999, " " * 777, "世" * 300, "x" * 200 + "é", "<|endoftext|>", "<|endoftext|><|endoftext|> x"]


@pytest.fixture(scope="module")
def made():
    path = automata.default_tokenizer()
    return automata.compiled(path), Tokenizer.from_file(path)


def encoded(encoder, texts):
    got = []
    for low, ids, at in encoder.encode(texts):
        assert low == len(got)
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(len(at) - 1)]
    return got


def test_ids_and_texts_equal_the_library(made, monkeypatch):
    automaton, library = made
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(6000)] + ODD + ["long text " * 100_000, " " * 600_000 + "x"]
    want = [library.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert encoded(automata.Encoder(automaton), texts) == want
    monkeypatch.setattr(automata, "CACHED_PIECES", 50)  # the cache begins anew
    monkeypatch.setattr(automata, "AT_ONCE", 100)
    assert encoded(automata.Encoder(automaton), texts[:2000] + ODD) == want[:2000] + want[6000 : 6000 + len(ODD)]
    for ids in want[:500] + want[6000:]:
        assert automaton.decode(np.asarray(ids, np.int64))[0].tobytes().decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_both_ways_through_the_tables_agree(made):
    automaton, _ = made
    rng = random.Random(2)
    words = [bytes(rng.choice(b"aabcdeinst -_0" + bytes([195, 169])) for _ in range(rng.randint(1, 80))) for _ in range(500)]
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    ids, begin = automaton.encode_words(np.frombuffer(b"".join(words), np.uint8).astype(np.int64), at)
    for i, w in enumerate(words):
        assert automaton.encode_long(w).tolist() == ids[begin[i] : begin[i + 1]].tolist()


def merged(word, merges):
    """Merges one after the other, each everywhere from left to right."""
    parts = list(word)
    for u, v in merges:
        i = 0
        while i + 1 < len(parts):
            if (parts[i], parts[i + 1]) == (u, v):
                parts[i : i + 2] = [u + v]
            i += 1
    return parts


def test_small_vocabularies_equal_merging_by_hand():
    rng = random.Random(5)
    for _ in range(60):
        tokens, merges = list("abc"), []
        for _ in range(rng.randint(1, 14)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens:
                tokens.append(u + v)
                merges.append((u, v))
        vocab = {c: i for i, c in enumerate([*automata.byte_letters(), *[t for t in tokens if len(t) > 1]])}
        automaton = automata.Automaton({"model": {"vocab": vocab, "merges": [list(m) for m in merges]}, "added_tokens": []})
        for _ in range(60):
            w = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            want = [vocab[t] for t in merged(w, merges)]
            assert automaton.encode_long(w.encode()).tolist() == want, (merges, w)
            assert automaton.encode_words(np.frombuffer(w.encode(), np.uint8).astype(np.int64), np.asarray([0, len(w)]))[0].tolist() == want


def test_round_trip_of_odd_tables(spark, made):
    _, library = made
    path = automata.default_tokenizer()
    docs = [(i, t) for i, t in enumerate(ODD + ["plain words, twice"] * 2)] + [(None, "no id"), (3, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 as ids", "'y' as decoded").repartition(3)
    rows = automata.decode(automata.encode(df, path), path).collect()
    got = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.n_tokens, bytes(r.decoded).decode()) for r in rows)
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids
    assert got == sorted((str(i), ids(t), len(ids(t)), t or "") for i, t in docs)
    assert automata.decode(automata.encode(df.limit(0), path), path).count() == 0


def test_query_digests(spark, sf, made):
    import hashlib

    _, library = made
    rows = {r.doc_id: r for r in automata.query(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
