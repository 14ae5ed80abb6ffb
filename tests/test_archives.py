import io
import zipfile

import pytest
from pyspark.sql import functions as F

from colwarden.plans.contract import CONTRACT_FIELDS
from colwarden.queries import packed
from colwarden.sources import archive
from colwarden.streaming.landing import landing_checks

FULL = ",".join(CONTRACT_FIELDS)

MATRIX = {
    "good": (packed([("a.csv", FULL.encode() + b"\n1\n")]), list(CONTRACT_FIELDS)),
    "upper case": (packed([("A.CSV", b"x,y\n")]), ["x", "y"]),
    "first of two": (packed([("t.txt", b"q"), ("b.csv", b"b\n"), ("a.csv", b"a\n")]), ["b"]),
    "repeated names": (packed([("a.csv", b"a,b,a\n")]), ["a", "b", "a"]),
    "byte order mark": (packed([("a.csv", "﻿a,b\n".encode())]), ["﻿a", "b"]),
    "invalid bytes": (packed([("a.csv", b"a\xff\xfeb,c\n")]), ["ab", "c"]),
    "quoted line feed": (packed([("a.csv", b'"a\nb",c\n')]), ["a\nb", "c"]),
    "blanks and quotes": (packed([("a.csv", ' a\t,"""b""", \u3000c\u00a0 ,""\n'.encode())]), ["a", "b", "c", ""]),
    "no line end": (packed([("a.csv", b"a,b")]), ["a", "b"]),
    "blank first line": (packed([("a.csv", b"\na,b\n")]), []),
}
BAD = {
    "text": (b"<html>", "not a ZIP archive"),
    "empty file": (b"", "not a ZIP archive"),
    "no CSV": (packed([("a.txt", b"x")]), "no CSV entry"),
    "empty CSV": (packed([("a.csv", b"")]), "empty CSV"),
    "cut": (packed([("a.csv", b"a,b\n" * 1000)])[:60], "unreadable archive"),
    "endless quote": (packed([("a.csv", b'"' + b"a" * 200_000)]), "unreadable CSV"),
}


@pytest.mark.parametrize("case", MATRIX)
def test_header(case):
    content, want = MATRIX[case]
    assert archive.header_of(content)[1] == want


@pytest.mark.parametrize("case", BAD)
def test_bad(case):
    content, reason = BAD[case]
    with pytest.raises(archive.BadArchive, match=reason):
        archive.header_of(content)


def test_options_and_limits(monkeypatch):
    assert archive.header_of(MATRIX["byte order mark"][0], strip_bom=True)[1] == ["a", "b"]
    monkeypatch.setattr(archive, "MOST_HEADER_CHARS", 10)
    with pytest.raises(archive.BadArchive, match="too long"):
        archive.header_of(packed([("a.csv", b"a,b,c,d,e,f,g,h\n")]))


def land(folder, name, content):
    (folder / name).write_bytes(content)


def test_relations(spark, tmp_path):
    for k, (content, _) in enumerate([*MATRIX.values(), *BAD.values()]):
        land(tmp_path, f"{k:02}.zip", content)
    headers = archive.archive_headers(archive.read_archives(spark, str(tmp_path))).cache()
    got = {r["path"][-6:-4]: r for r in headers.collect()}
    for k, (_, want) in enumerate(MATRIX.values()):
        assert got[f"{k:02}"]["fields"] == want and got[f"{k:02}"]["reason"] is None
    assert "11" not in got  # Spark makes no row of an empty file
    for k, (content, reason) in enumerate(BAD.values(), len(MATRIX)):
        if content:
            assert got[f"{k:02}"]["fields"] == [] and reason in got[f"{k:02}"]["reason"] and got[f"{k:02}"]["entry"] is None
    names = [r["field"] for r in archive.discovered(headers).collect() if r["source"].endswith("03.zip")]
    assert sorted(names) == ["a", "b"]
    checks = {r["path"][-6:-4]: r for r in archive.check_headers(headers).collect()}
    assert checks["00"]["all_available"] and checks["00"]["n_fields"] == 54 and sum(r["all_available"] for r in checks.values()) == 1
    assert checks["12"]["missing"] == sorted(CONTRACT_FIELDS)
    assert not any(r["all_available"] for r in archive.check_headers(headers, []).collect() if r["reason"])


def test_rows(spark, tmp_path):
    body = 'b,"x ""a""",a,a\n1,2,3,4\n\n"u\nv",w\n'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("d.csv", body)
    land(tmp_path, "d.zip", out.getvalue())
    rows = archive.archive_rows(archive.read_archives(spark, str(tmp_path)), ["a", "b", "none"], batch=1).collect()
    assert [tuple(r) for r in rows] == [("3", "1", None), (None, "u\nv", None)]


def test_magic_bytes(spark):
    from colwarden.functions import scalar

    rows = [(bytearray(b), k) for k, b in enumerate([b"PK\x03\x04", b"PK", b"P", b"", b"<html>"])] + [(None, 5)]
    got = spark.createDataFrame(rows, "c binary, k int").select("k", scalar.is_zip(F.col("c")).alias("zip"), scalar.head(F.col("c"), 2).alias("head")).orderBy("k").collect()
    assert [r["zip"] for r in got] == [True, True, False, False, False, False]
    assert [r["head"] for r in got] == [b"PK", b"PK", b"P", b"", b"<h", None]


def test_stream(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder, "1.zip", MATRIX["good"][0])
    land(folder, "2.zip", MATRIX["upper case"][0])
    query = landing_checks(spark, str(folder), files_per_trigger=1).writeStream.format("memory").queryName("landed").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        query.processAllAvailable()
        land(folder, "3.zip", BAD["text"][0])
        query.processAllAvailable()
        got = {r["path"][-5]: r for r in spark.table("landed").collect()}
        assert {k: r["all_available"] for k, r in got.items()} == {"1": True, "2": False, "3": False} and got["3"]["reason"]
    finally:
        query.stop()


def test_rows_of_every_csv_entry(spark, tmp_path):
    land(tmp_path, "two.zip", packed([("t.txt", b"q"), ("b.csv", b"a,b\n1,2\n3,4\n"), ("empty.csv", b""), ("a.CSV", b"c,b,a\n9,6,5\n")]))
    land(tmp_path, "same.zip", packed([("x.csv", b"a\n7\n")]))
    got = archive.archive_rows(archive.read_archives(spark, str(tmp_path)), ["a", "b", "absent"], batch=2)
    assert sorted(map(tuple, got.collect())) == [("1", "2", None), ("3", "4", None), ("5", "6", None), ("7", None, None)]
