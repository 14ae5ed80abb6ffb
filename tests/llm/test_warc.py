import base64
import gzip
import hashlib
import json
import random

import pytest

from colwarden.llm import warc
from colwarden.llm.queries import op7_warc_normaliser


def brute(rows):
    last = {}
    for i, (ident, html) in enumerate(rows):
        key = (ident is not None, ident or 0)
        if html not in last or key > last[html][0]:
            last[html] = (key, i)
    out = []
    for i, (ident, html) in enumerate(rows):
        told = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        # of equal ids any one may be the response
        out.append((ident, len((html or "").encode()), told, "response" if last[html][1] == i else "revisit", None if last[html][1] == i else rows[last[html][1]][0]))
    return sorted(map(str, out))


def test_round_trip(spark, tmp_path):
    rows = [(1, "<p>é</p>"), (2, "<p>é</p>"), (3, ""), (4, ""), (5, "x\r\n\r\nWARC/1.1\r\n"), (6, "long " * 300_000), (7, "\r\n"), (8, "same"), (8, "same"), (None, "same"), (None, "only null")]
    df = spark.createDataFrame([(i, f"http://a/{i}\n b" if i != 5 else None, h, "x") for i, h in rows], "page_id long, url string, html string, file string").repartition(3)
    got = sorted(str(tuple(r)) for r in warc.round_trip(df, tmp_path.as_uri()).collect())
    assert got == brute(rows)
    entries = 0
    for path in tmp_path.glob("norm-*.gz"):
        raw = path.read_bytes()
        whole = gzip.decompress(raw)
        assert sum(1 for _ in warc.records_of([whole])) == len((lines := (tmp_path / f"{path.name}.idx").read_text().splitlines()))
        for entry in map(json.loads, lines):
            member = gzip.decompress(raw[entry["offset"] : entry["offset"] + entry["length"]])
            assert member.startswith(b"WARC/1.1\r\n") and entry["type"].encode() in member
            entries += 1
    assert entries == len(rows)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "")], "page_id long, url string, html string")
    assert sorted(tuple(r)[3:] for r in warc.round_trip(df).collect()) == [("response", None), ("revisit", 2)]
    assert warc.round_trip(df.limit(0)).count() == 0


def test_streams_of_any_cut():
    rng = random.Random(0)
    raw = [warc.record("response", f"{i}:x-0", "u", "D", n, bytes(rng.randrange(256) for _ in range(n))) for i, n in enumerate([0, 1, 5, 700, 3000])]
    packed = gzip.compress(b"".join(raw[:3])) + b"\0\0" + gzip.compress(b"".join(raw[3:]))
    for step in (1, 7, 100, 10**6):
        got = list(warc.records_of(warc.inflate(packed[i : i + step] for i in range(0, len(packed), step))))
        assert [len(warc.payload_of(b)[1]) for _, b in got] == [0, 1, 5, 700, 3000]
    with pytest.raises(warc.Truncated):
        list(warc.records_of(warc.inflate([packed[:-40]])))
    with pytest.raises(warc.Truncated):
        list(warc.records_of([raw[3][:-30]]))


def foreign(kind, ident, block, *lines):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"warc-record-id: <urn:uuid:{ident}>", *lines, f"Content-Length: {len(block)}"]
    return warc.whole("\r\n".join(head).encode(), block)


def test_records_of_other_writers_stay_as_they_are(spark, tmp_path):
    missing = b"HTTP/1.1 404 Not Found\r\nServer: x\r\nTransfer-Encoding: chunked\r\n\r\n4\r\ngone\r\n0\r\n\r\n"
    first = [
        foreign("warcinfo", 1, b"software: y\r\n", "Content-Type: application/warc-fields"),
        foreign("request", 2, b"GET / HTTP/1.1\r\n\r\n", "WARC-Target-URI: http://a/"),
        foreign("response", 3, missing, "WARC-IP-Address: 10.0.0.1", "WARC-Block-Digest: sha1:OLD", " FOLDED", "X-Own: a", "\tb"),
        foreign("metadata", 4, b"", "WARC-Concurrent-To: <urn:uuid:3>"),
        foreign("response", 5, b"dns answer", "Content-Type: text/dns"),
        foreign("response", 6, b"dns answer", "Content-Type: text/dns"),
        foreign("revisit", 7, b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Refers-To: <urn:uuid:0>"),
    ]
    second = [foreign("response", 8, missing), foreign("response", 9, b"HTTP/1.1 200 OK\r\n\r\nalone")]
    (tmp_path / "in").mkdir()
    for name, raw in (("a.gz", first), ("b.gz", second)):
        (tmp_path / "in" / name).write_bytes(gzip.compress(b"".join(raw)))
    files = spark.createDataFrame([("a.gz",), ("b.gz",)], "file string")
    made = warc.rewrite(files, (tmp_path / "in").as_uri(), (tmp_path / "out").as_uri())
    got = {}
    for r in made.collect():
        raw = (tmp_path / "out" / r["file"]).read_bytes()
        for entry in map(json.loads, (tmp_path / "out" / r["index_file"]).read_text().splitlines()):
            got[entry["id"]] = gzip.decompress(raw[entry["offset"] : entry["offset"] + entry["length"]])
    want = dict(zip((f"<urn:uuid:{k}>" for k in range(1, 10)), first + second, strict=True))
    turned = [k for k in want if got[k] != want[k]]
    assert got.keys() == want.keys() and len(turned) == 1 and turned[0] in ("<urn:uuid:3>", "<urn:uuid:8>")
    other = {"<urn:uuid:3>": "<urn:uuid:8>", "<urn:uuid:8>": "<urn:uuid:3>"}[turned[0]]
    ((head, block),) = warc.records_of([got[turned[0]]])
    fields = warc.head_of(head)
    assert block == missing[: missing.index(b"\r\n\r\n") + 4] and fields["warc-type"] == "revisit" and fields["warc-refers-to"] == other
    rows = warc.read_members(made, (tmp_path / "out").as_uri()).collect()
    assert sorted(r["record_type"] for r in rows) == ["response"] * 4 + ["revisit"] * 2 and all(r["page_id"] is None for r in rows)
    assert warc.digest(missing[missing.index(b"\r\n\r\n") + 4 :]) in {r["payload_digest"] for r in rows if r["record_type"] == "revisit"}
    assert not list((tmp_path / "out").glob("between*"))


def test_a_revisit_keeps_the_other_header_lines():
    block = b"HTTP/1.1 404 Not Found\r\nServer: x\r\n\r\ngone"
    raw = foreign("response", 3, block, "WARC-IP-Address: 10.0.0.1", "WARC-Block-Digest: sha1:OLD", " FOLDED", "X-Own: a", "\tb")
    ((head, kept),) = warc.records_of([raw])
    ((head, kept),) = warc.records_of([warc.revisit_of(head, kept, "<urn:uuid:8>")])
    assert kept == b"HTTP/1.1 404 Not Found\r\nServer: x\r\n\r\n"
    fields = warc.head_of(head)
    assert fields.pop("warc-profile") == warc.PROFILE
    assert fields == {"warc-type": "revisit", "warc-record-id": "<urn:uuid:3>", "warc-ip-address": "10.0.0.1", "warc-block-digest": f"sha1:{warc.digest(kept)}", "x-own": "a b", "warc-payload-digest": f"sha1:{warc.digest(b'gone')}", "content-length": str(len(kept)), "warc-refers-to": "<urn:uuid:8>"}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r[0], r[1] or "") for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect()]
    assert sorted(str(tuple(r)) for r in op7_warc_normaliser(spark, sf).collect()) == brute(rows)


def test_broken_archives_keep_their_whole_records(spark, tmp_path):
    record = lambda k, body: foreign("response", k, b"HTTP/1.1 200 OK\r\n\r\n" + body)
    raw = [record(k, bytes([65 + k]) * 3_000) for k in range(6)]
    packed = gzip.compress(b"".join(raw[:3]))
    headless = b"WARC/1.0\r\nWARC-Type: response\r\n\r\nx\r\n\r\n"
    made = {"whole.gz": gzip.compress(b"".join([raw[0], *raw[3:5]])), "cut.gz": gzip.compress(b"".join(raw[:3]), 0)[:-3_100], "no_length.gz": gzip.compress(raw[5] + headless + raw[0]), "text.gz": b"no archive", "flipped.gz": packed[:-6] + b"......", "empty.gz": b""}
    (tmp_path / "in").mkdir()
    for name, content in made.items():
        (tmp_path / "in" / name).write_bytes(content)
    files = spark.createDataFrame([(n,) for n in made], "file string")
    index = warc.normalise(files, (tmp_path / "in").as_uri(), (tmp_path / "between").as_uri()).collect()
    reasons = {r["reason"].split(":")[0]: r["reason"] for r in index if r["reason"]}
    assert set(reasons) == {"cut.gz", "no_length.gz", "text.gz", "flipped.gz"} and "length" in reasons["no_length.gz"]
    kept = sorted(r["id"] for r in index if r["id"])
    assert kept == sorted(f"<urn:uuid:{k}>" for k in (0, 1, 0, 3, 4, 5))
    out = warc.rewrite(files, (tmp_path / "in").as_uri(), (tmp_path / "out").as_uri())
    rows = warc.read_members(out, (tmp_path / "out").as_uri()).collect()
    assert sorted(r["record_type"] for r in rows) == ["response"] * 5 + ["revisit"] and None not in {r["payload_digest"] for r in rows}
