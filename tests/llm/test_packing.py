import zlib

import numpy as np

from llm import packing


def test_pieces_rebuild_the_stream(spark):
    path = packing.default_tokenizer()
    docs = [(i, t) for i, t in enumerate(["A cat's tale, 12 tales.", None, "", "Straße É" * 50, "<|endoftext|> x", "a\x1cb\x0bc"] * 5)] + [(None, "zz"), (3, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 as start", "'y' as ids").repartition(3)
    got = packing.pack(df, path, length=64).collect()
    t = packing._tokenizer(path)
    want = sorted((str(i), tuple(t.encode(x or "", add_special_tokens=False).ids + [1])) for i, x in docs)
    by, seen = {}, []
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert len(r.ids) == 4 * r.length and r.offset + r.length <= 64
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.start == 0:
            seen.append((str(r.doc_id), []))
        assert len(seen[-1][1]) == r.start and seen[-1][0] == str(r.doc_id)
        seen[-1][1].extend(np.frombuffer(r.ids, "<u4").tolist())
    assert sorted((d, tuple(x)) for d, x in seen) == want
    for s, pieces in by.items():
        at = 0
        for offset, length in pieces:
            assert offset == at
            at += length
        assert at == 64 or s == max(by)
    assert packing.pack(df.limit(0), path).count() == 0
    one = packing.with_digests(packing.pack(df, path)).filter("doc_id = 0").first()
    ids = np.asarray(t.encode(docs[0][1], add_special_tokens=False).ids + [1], "<u4")
    assert one.ids_crc32 == zlib.crc32(ids.tobytes())


def test_encoder_equals_the_tokenizer():
    import random

    import pyarrow as pa

    from llm.textcodes import byte_chunks

    rng = random.Random(1)
    alphabet = [*"abcXYZ019'`-_.,;<>|!? \t\n\x0b\x1c\x1f\x00", "’", "\x85", "\xa0", "é", "É", "ß", "İ", "Σ", "ς", "́", "世", "界", "🙂", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "''s", "<|", "ﬁ", "Ⅷ", "²", "　", "​"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", None, "a" * 500, "世" * 300, "x" * 63 + "é", "x" * 64, "x" * 65, "long text " * 20_000]
    t, encoder, got = packing._tokenizer(packing.default_tokenizer()), packing.WordEncoder(packing.default_tokenizer()), []
    for _, data, offsets in byte_chunks(pa.array(texts, pa.string()), 5000):
        ids, at = encoder.encode_texts(data, offsets)
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(len(at) - 1)]
    assert got == [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]
