import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, StringStartsWith

from colwarden.queries import packed
from colwarden.sources import archive_table as at
from colwarden.sources.archive import BadArchive
from colwarden.sources.storage import opened

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="module")
def written(spark, orders, tmp_path_factory):
    folder = tmp_path_factory.mktemp("archives").as_uri()
    manifest = at.write_archives(orders.repartitionByRange(3, "o_orderdate").sortWithinPartitions("o_orderdate"), folder, zones=("o_orderdate", "o_orderpriority"), rows_per_entry=90, archive_bytes=5_000)
    return folder, manifest


def test_manifest_tells_what_the_directories_tell(spark, orders, written):
    folder, manifest = written
    entries = at.entries_of(at.archive_files(spark, folder))
    place = ["pos", "entry", "method", "offset", "compressed", "size", "crc"]
    name = F.element_at(F.split("path", "/"), -1).alias("path")
    assert sorted(manifest.select(name, *place).collect()) == sorted(entries.select(name, *place).collect())
    assert manifest.agg(F.sum("rows")).first()[0] == orders.count()
    assert entries.select("path").distinct().count() > 3  # an archive ends at its size
    got = at.entry_rows(entries, orders.columns, split_bytes=4_000)
    assert sorted(map(str, got.collect())) == sorted(map(str, orders.select([F.col(c).cast("string") for c in orders.columns]).collect()))
    assert got.rdd.getNumPartitions() > 3


def test_headers_need_the_first_kilobytes_only(spark, tmp_path):
    body = os.urandom(1 << 20).hex().encode()
    (tmp_path / "big.zip").write_bytes(packed([("skip.txt", body), ("b.CSV", b"b,c\n" + body), ("a.csv", b"a\n")]))
    (tmp_path / "none.zip").write_bytes(packed([("x.txt", b"x")]))
    (tmp_path / "text.zip").write_bytes(b"no archive")
    (tmp_path / "cut.zip").write_bytes((tmp_path / "big.zip").read_bytes()[:-40])
    (tmp_path / "empty.zip").write_bytes(packed([("e.csv", b"")]))
    got = {r["path"].rpartition("/")[2]: r for r in at.first_headers(at.entries_of(at.archive_files(spark, tmp_path.as_uri()))).collect()}
    assert (got["big.zip"]["entry"], got["big.zip"]["fields"]) == ("b.CSV", ["b", "c"]) and got["big.zip"]["bytes_read"] <= at.FIRST_PIECE * 5
    assert {k: (r["fields"], r["reason"].split(":")[0]) for k, r in got.items() if r["reason"]} == {
        "none.zip": ([], "no CSV entry"), "text.zip": ([], "unreadable archive"), "cut.zip": ([], "unreadable archive"), "empty.zip": ([], "empty CSV"),
    }


def test_directory_is_read_by_range(tmp_path):
    (tmp_path / "a.zip").write_bytes(packed([(f"{k}.csv", os.urandom(5_000)) for k in range(200)]))
    store, where = opened(str(tmp_path / "a.zip"))
    with store.open_input_file(where) as raw:
        file = at.Counted(raw)
        assert len(at.directory(file)) == 200 and file.read_bytes < 100_000 < raw.size()


def test_damage(spark, tmp_path):
    line = b"x" * 50 + b",1\n"
    good = packed([("a.csv", b"a,b\n" + line * 2_000), ("b.csv", b"b,a\n2,y\n")])
    at_middle = bytearray(good)
    with zipfile.ZipFile(tmp_path / "stored.zip", "w") as z:
        z.writestr("s.csv", b"a,b\n" + line * 3)
    stored = bytearray((tmp_path / "stored.zip").read_bytes())
    stored[stored.index(b"xxx")] ^= 1
    (tmp_path / "stored.zip").write_bytes(stored)
    at_middle[60] ^= 0xFF
    (tmp_path / "broken.zip").write_bytes(at_middle)
    entries = at.entries_of(at.archive_files(spark, tmp_path.as_uri()))
    rows = at.entry_rows(entries, ["a", "b", "absent"], errors_as="wrong").collect()
    reasons = [r["wrong"].split(":")[0] for r in rows if r["wrong"]]
    assert sorted(reasons) == ["a.csv", "s.csv"] and ("y", "2", None, None) in rows  # the whole entry beside the broken one stays
    with pytest.raises(Exception, match="a.csv|s.csv"):
        at.entry_rows(entries, ["a"]).count()


def test_streams_at_every_size():
    import io
    import random

    rng = random.Random(1)
    for size in (0, 1, 4_095, 4_096, 4_097, 300_000):
        content = bytes(rng.choices(b"ab,\n", k=size))
        for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", method) as z:
                z.writestr("a.csv", content)
            (_, _, m, offset, compressed, _, crc, _), = at.directory(out)
            for step in (1, 100, 8_192) if size < 5_000 else (8_192,):
                stream, got = at.EntryStream(out, m, offset, compressed, crc), b""
                while part := stream.read(step):
                    got += part
                assert got == content
            if compressed > 5:
                with pytest.raises(BadArchive):
                    io.BufferedReader(at.EntryStream(io.BytesIO(out.getvalue()[: offset + 35 + compressed - 3]), m, offset, compressed, crc)).read()


def test_pruning(spark, orders, written):
    folder, manifest = written
    every = manifest.count()

    def kept(*filters):
        out = manifest
        for f in filters:
            if (test := at.may_hold(f)) is not None:
                out = out.where(test)
        return out.count()

    day, level = ("o_orderdate",), ("o_orderpriority",)
    assert 0 < kept(GreaterThan(day, "1997-03-01"), LessThan(day, "1997-06-01")) < every / 4
    some = orders.first()["o_orderdate"].isoformat(" ")
    assert 0 < kept(EqualTo(day, some)) < every / 4
    assert kept(In(day, (some, "2100-01-01"))) == kept(EqualTo(day, some)) and kept(In(level, ("9",))) == 0
    assert kept(In(level, ("1-URGENT", None))) == every  # says nothing that zones can tell
    assert 0 < kept(StringStartsWith(day, "1997-03")) < every / 4
    assert kept(IsNull(day)) == 0 and kept(IsNotNull(day)) == every and kept(EqualTo(day, None)) == every


def test_pruned_reads_equal_filters_in_any_order_of_plans(spark, orders, written):
    folder, manifest = written
    text = orders.select([F.col(c).cast("string") for c in orders.columns])
    day = ("o_orderdate",)
    cases = [
        ([GreaterThanOrEqual(day, "1997-03-01"), LessThan(day, "1997-06-01"), In(("o_orderpriority",), ("1-URGENT", "2-HIGH"))], "o_orderdate >= '1997-03-01' AND o_orderdate < '1997-06-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"),
        ([], "true"),
        ([StringStartsWith(day, "1995-0")], "o_orderdate LIKE '1995-0%'"),
        ([GreaterThan(day, "2200")], "false"),
        ([EqualTo(("o_orderstatus",), "F")], "o_orderstatus = 'F'"),  # no zone
    ]
    frames = [at.read_pruned(spark, folder, ["o_orderkey"], f, split_bytes=1) for f, _ in cases]
    for got, (_, want) in zip(frames, cases, strict=True):
        assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in text.where(want).select("o_orderkey").collect())
    assert frames[2].union(frames[0]).count() == frames[2].count() + frames[0].count()
    assert frames[2].rdd.getNumPartitions() < frames[1].rdd.getNumPartitions() / 2  # entries skipped


def test_empty_table_and_odd_cells(spark, orders, tmp_path):
    folder = (tmp_path / "none").as_uri()
    assert at.write_archives(orders.limit(0), folder).count() == 0
    rows = [(1, 'a "b",\n c'), (2, None), (3, ""), (4, "é\r\n")]
    folder = (tmp_path / "odd").as_uri()
    manifest = at.write_archives(spark.createDataFrame(rows, "k INT, `t x` STRING").coalesce(1), folder, zones=["t x"])
    assert manifest.first()["nulls:t x"] == 1
    got = at.entry_rows(at.entries_of(at.archive_files(spark, folder)), ["t x", "k"]).collect()
    assert sorted((int(r["k"]), r["t x"]) for r in got) == [(k, t or "") for k, t in rows]
