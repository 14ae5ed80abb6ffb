import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from colwarden.llm import sp_codec
from colwarden.llm.queries import default_model, op8_sentencepiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=default_model())


@pytest.fixture(scope="module")
def own():
    return sp_codec.Codec(default_model(), remembered=500)


def same(own, library, text):
    ids, decoded = own.convert(text)
    want = library.encode(text)
    assert memoryview(ids).cast("i").tolist() == want, text
    assert decoded.decode() == library.decode(want) == own.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40) | st.text("aehinorst. ,▁\n", max_size=60))
def test_as_the_library(own, library, text):
    same(own, library, text)


def test_odd_texts(own, library):
    for text in ["", " ", "   ", "\n", "▁", "<s></s><unk><0x41>", "x" * 3000, " " * 300 + "x", "a,b.c ,d .e..f.,g", "\0a\0 b", "é" * 50 + "日本😀\r\n\t"]:
        same(own, library, text)


def test_decode_any_ids(own, library):
    rng = random.Random(5)
    for _ in range(1500):
        ids = [rng.randrange(library.get_piece_size()) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids)


def test_tables(spark, library):
    rows = [(1, "a b", "k"), (1, "a b", "k"), (None, None, "k"), (3, "", None), (4, "lo ng " * 5000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Tokens string")
    got = sorted(sp_codec.encode(df, default_model()).collect(), key=str)
    want = sorted([(i, k, library.encode(t or ""), t or "") for i, t, k in rows], key=str)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sp_codec.encode(df.limit(0), default_model()).count() == 0


def test_clashing_names(spark, library):
    df = spark.createDataFrame([(1, "a b", "mine", "x", 7)], "doc_id long, text string, IDS string, decoded string, _ids int")
    coded = sp_codec.encode(df, default_model())
    assert coded.columns == ["doc_id", "IDS", "decoded", "_ids", "__ids", "_decoded"]
    assert tuple(coded.first()) == (1, "mine", "x", 7, library.encode("a b"), "a b")


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(r["doc_id"], len(ids := library.encode(r["text"] or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for r in rows]
    assert sorted(tuple(r) for r in op8_sentencepiece(spark, sf).collect()) == sorted(want)
