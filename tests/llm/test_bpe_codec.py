import random

import public_tokenizers as P
import pytest
import tiktoken

from colwarden.llm import bpe_codec

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.ByteCodec(bpe_codec.read_ranks(RANKS), P.PATTERN, remembered=500, stretch=200)


def ids(codec, text):
    ((packed, decoded),) = codec.convert([text])
    assert decoded == text.encode()
    return memoryview(packed).cast("i").tolist()


def test_equals_the_library(codec, library):
    rng = random.Random(5)
    tokens = [t.decode(errors="ignore") for t in bpe_codec.read_ranks(RANKS)]
    marks = [" ", "  ", "\n", "\t", "　", "\x1c", "\x85", "'s", "'LL", "\0", "﻿", "😀", "é", "é", "日本", "½", "١٢", "<|endoftext|>", "\r\n", " ", "▁"]
    for _ in range(3_000):
        text = "".join(rng.choice(tokens if rng.random() < 0.5 else marks) for _ in range(rng.randrange(60)))
        assert ids(codec, text) == library.encode_ordinary(text)
    for text in ("", "a", " " * 5_000, "ab" * 40_000, "x y " * 10_000, "word  " * 3_000):
        assert ids(codec, text) == library.encode_ordinary(text)


def test_tokens_that_no_merge_leads_to():
    ranks = {bytes([b]): b for b in range(256)} | {b"abcd": 256, b"bc": 257}
    own = bpe_codec.ByteCodec(ranks, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert own.whole == {b"abcd": 256}
    for text in ("abcd", "abcd abcd", "xabcd", "abcabcd", "bcbc"):
        assert ids(own, text) == library.encode_ordinary(text)


def test_refuses_other_vocabularies():
    with pytest.raises(ValueError):
        bpe_codec.serialise({bytes([b]): b for b in range(255)})
    with pytest.raises(ValueError):
        bpe_codec.serialise({bytes([b]): b + 1 for b in range(256)})


def test_odd_rows(spark, library):
    rows = [(1, "The cat sat.\n", "x"), (1, "The cat sat.\n", "x"), (2, None, None), (None, "", "y"), (3, "naïve 日本 " * 30_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, ids STRING")
    got = bpe_codec.encode(docs, RANKS, P.PATTERN)
    assert got.columns == ["doc_id", "ids", "_ids", "decoded"]
    found = {(r[0], r[1]): (r[2], bytes(r[3])) for r in got.collect()}
    assert got.count() == len(rows)
    for i, t, s in rows:
        assert found[i, s] == (library.encode_ordinary(t or ""), (t or "").encode())
    assert bpe_codec.encode(docs.limit(0), RANKS, P.PATTERN).collect() == []
