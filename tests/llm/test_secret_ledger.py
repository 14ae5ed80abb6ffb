import hashlib
import re

import pytest
from pyspark.sql import functions as F

from colwarden.llm import secret_ledger as sl
from colwarden.llm.queries import op9_secret_ledger

PATTERNS = {
    "assign": re.compile(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute(text):
    text = text or ""
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            if {"assign": lambda m=m: len(m[2]) >= 6, "access": lambda m=m: len(m[0]) >= 20, "hex": lambda m=m: len(m[0]) >= 24}[kind]():
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


ODD = [
    None,
    "",
    "password=abcdef",
    "PassWord\"  :  'abc/+_.=-9 tail ünï 😀 token: abcdefg",
    "secret=token:abcdefgh",
    "secret=token=abcdefgh api_key='xx' apikey=\"123456\"",
    "😀😀 AKIA" + "A" * 16 + "é AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 14,
    "f" * 23 + " " + "0" * 24 + "g" + "ab12" * 9,
    "token=" + "a" * 40,
    "token=" + "a" * 40,
    "x " * 50_000 + "passwd = hunter22 " + "y" * 100_000,
    "password password=password=password=",
    "tokenİ=abcdefgh ſecret=abcdefgh",
]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(2, ODD[2], "again")], "doc_id long, text string, blob string")
    keys, entries = sl.scan(docs)
    got = [(r["id"], joined([(s["start"], s["rank"], s["end"], s["kind"]) for s in r["spans"]])) for r in sl.findings(keys, entries).collect()]
    assert sorted(got) == sorted([(i, joined(brute(t))) for i, t in enumerate(ODD)] + [(2, joined(brute(ODD[2])))])


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    want = {r["doc_id"]: joined(brute(r["text"])) for r in rows}
    got = op9_secret_ledger(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: r["spans"] for r in got} == want and len(got) == len(rows) and any(want.values())
    assert all(r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest() for r in got)
    assert all(r["n_hex"] == r["spans"].count("hex:") for r in got)


def test_ledger_scans_only_what_it_lacks(spark):
    docs = spark.createDataFrame([(1, "token=abcdef12"), (2, "token=abcdef12"), (3, "clean")], "doc_id long, text string")
    _, old = sl.scan(docs)
    old = spark.createDataFrame(old.collect(), sl.LEDGER)
    assert old.count() == 6
    # a marked entry shows whether the old finding is used or found again
    marked = old.withColumn("spans", F.expr("transform(spans, s -> named_struct('start', s.start + 100, 'end', s.end + 100))"))
    more = docs.union(spark.createDataFrame([(4, "passwd=zzzzzz")], docs.schema))
    rules = (*sl.RULES[:2], sl.Rule("hex", r"[0-9a-f]{8,}", version=2))
    keys, entries = sl.scan(more, marked, rules)
    got = {r["id"]: joined([tuple(s) for s in r["spans"]]) for r in sl.findings(keys, entries, rules).collect()}
    assert got[1] == got[2] != joined(brute("token=abcdef12")) and "assign:100:114" in got[1]
    assert got[3] == "" and got[4] == "assign:0:13"


def test_redact(spark):
    docs = spark.createDataFrame([(1, "a token=abcdef12 b", "k"), (1, "a token=abcdef12 b", "k"), (2, None, "k"), (3, "clean", None), (None, "x token=" + "a" * 30, "k")], "doc_id long, text string, Spans string")
    got = sorted(sl.redact(docs).collect(), key=str)
    assert got == sorted([(1, "a [SECRET] b", "k"), (1, "a [SECRET] b", "k"), (2, None, "k"), (3, "clean", None), (None, "x [SECRET]", "k")], key=str)


@pytest.mark.parametrize("schema", ["doc_id long, text string"])
def test_empty(spark, schema):
    keys, entries = sl.scan(spark.createDataFrame([], schema))
    assert sl.findings(keys, entries).count() == entries.count() == 0


def test_stored_ledger_scans_unseen_blobs_only(spark, tmp_path, monkeypatch):
    scanned, spill = [], sl.spill

    def counting(df, name):
        out = spill(df, name)
        if name == "unseen":
            scanned.append(out.count())
        return out

    monkeypatch.setattr(sl, "spill", counting)
    for most in (sl.BROADCAST_BLOBS, 0):  # both ways of finding the texts
        monkeypatch.setattr(sl, "BROADCAST_BLOBS", most)
        scanned.clear()
        ledger = sl.Ledger(str(tmp_path / f"ledger{most}"))
        rows = [(i, f"token = abcdef{i % 7}") for i in range(20)] + [(None, None), (50, "")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = [sorted(sl.findings(*sl.scan_into(docs, ledger)).collect(), key=str) for _ in range(2)]
        assert got[0] == got[1] and len(got[0]) == 22
        more = docs.unionByName(spark.createDataFrame([(60, "secret: zzzzzz9"), (61, "token = abcdef1")], docs.schema))
        keys, entries = sl.scan_into(more, ledger)
        assert sl.findings(keys, entries).where("size(spans) = 1").count() == 22
        newer = (sl.Rule("hex", "[0-9a-f]{6,}", version=2), *sl.RULES[:2])
        sl.scan_into(more, ledger, newer)
        sl.scan_into(more, ledger, newer)
        assert scanned == [8, 0, 1, 9, 0]
        assert ledger.read(spark).count() == 9 * 3 + 9


def exchanges_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_of_a_small_scan(spark, tmp_path):
    """A small scan opens the buckets of its blobs only, and a large one moves no entry of the ledger."""
    ledger = sl.Ledger(f"file://{tmp_path}/ledger")
    docs = spark.createDataFrame([(i, f"text {i} token=abcdef{i}") for i in range(2_000)], "doc_id long, text string")
    sl.scan_into(docs, ledger)
    known = ledger.read(spark)
    blobs = [r[0] for r in known.select("blob").limit(1).collect()]
    # buckets are pruned in either kind of scan; the plan tells their number in one of them
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 16" in exchanges_of(known.where(F.col("blob").isin(blobs)))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    own = known.dropDuplicates(["blob", "rule", "version"]).groupBy("blob").count()
    assert "Exchange" not in exchanges_of(own)
    more = docs.limit(3).unionByName(spark.createDataFrame([(9_999, "secret=zzzzzzz")], docs.schema))
    keys, entries = sl.scan_into(more, ledger)
    assert entries.count() == 4 * 3 and ledger.read(spark).count() == 2_001 * 3
    files = lambda: [p for p in (tmp_path / "ledger").rglob("*.parquet")]
    assert len(files()) == 17
    before = sorted(map(str, ledger.read(spark).collect()))
    ledger.compact(spark)
    assert sorted(map(str, ledger.read(spark).collect())) == before and len(files()) == 16
    assert [n for _, n in ledger.layouts(spark)] == [16]
    keys, entries = sl.scan_into(docs, ledger)
    assert entries.count() == 6_000 and ledger.read(spark).count() == 2_001 * 3
    assert [sl.Ledger("x", 100).next_layout(0, n)[1] for n in (0, 1_600, 1_601, 10_000, 10**9)] == [16, 16, 32, 128, 16_384]


def test_history_goes_with_the_row(spark):
    rows = [(1, "token=abcdef12", "a.py", 1), (1, "clean", "a.py", 2), (2, "token=abcdef12", "b.py", 1), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string, version int")
    got = sl.findings(*sl.scan(docs, history=("path", "version"))).collect()
    assert sorted(((r.id, r.path, r.version, len(r.spans)) for r in got), key=str) == sorted([(1, "a.py", 1, 1), (1, "a.py", 2, 0), (2, "b.py", 1, 1), (None, None, None, 0)], key=str)
    with pytest.raises(ValueError, match="history"):
        sl.scan(docs.withColumnRenamed("path", "Blob"), history=("Blob",))
