import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from colwarden.llm import quality_bands as qb
from colwarden.llm.queries import op3_quality_bands


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "#", "\n", " ", " ", "\x1c"]), max_size=120).map(" ".join) | st.text("ab \n", max_size=200) | st.text(max_size=80))
def test_counts(text):
    assert qb.counts(text.encode()) == brute(text)


def test_bands(spark):
    rng = random.Random(3)
    letters = "etaoinshrdlu"
    prose = lambda n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))
    mash = "".join(chr(rng.randrange(33, 1500)) for _ in range(3000))
    rows = [(1, prose(300)), (2, " ".join(w for w in prose(40).split() for _ in range(7))), (3, " ".join(mash[i : i + 6] for i in range(0, 3000, 6))), (4, None), (5, ""), (6, "one two"), (7, prose(30_000)), (7, prose(30_000)), (None, prose(60)), (8, prose(2000) + " spam" * 6000)]
    df = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, kept boolean")
    got = qb.judge(df).collect()
    assert len(got) == len(rows) and qb.judge(df.limit(0)).count() == 0
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: True, None: True, 8: False}
    failed = {r["doc_id"]: r["base_failed"] for r in got}
    assert failed[4] and failed[5] and failed[6] and failed[8] and not failed[2] and not failed[3]


def test_every_byte_is_in_a_judged_chunk():
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(n)).encode()[: n * 4]
    junk = b"spam " * 800
    own = qb.Judge(qb.Bands())
    short, tail = prose(1024) + junk[:2500], prose(2048) + junk[:3900]
    for text in (short, tail):  # the whole ratio lets both through
        low, high = qb.band_of(own.bands, len(text))
        assert low <= own.ratios(text)[0] <= high
    assert own.kept(short)[0] is False and own.kept(short)[2:] == (2, 1)
    assert own.kept(tail)[0] is False and own.kept(tail)[2:] == (3, 1)
    # a few odd bytes at the end weigh no more than they are
    assert own.kept(prose(2048) + b"#!?")[0] is True
    assert own.kept(b"")[1:] == (None, 0, 0) and own.kept(prose(200))[2:] == (1, 0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = {r["doc_id"]: brute(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op3_quality_bands(spark, sf).collect()
    assert {r["doc_id"]: tuple(r)[1:6] for r in got} == want
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) and not (r["kept"] and r["base_failed"]) for r in got)
    assert sum(r["kept"] for r in got) > 0.8 * sum(not r["base_failed"] for r in got)
