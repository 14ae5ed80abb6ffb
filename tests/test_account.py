"""The typed layer and its account."""

from decimal import Decimal

import pytest

from colwarden.operators.account import typed_layer

ROWS = [("1", "2024-01-05", "1.25", "x"), ("one", "2024-02-30", None, "x"), (None, None, None, None), ("3", "", "12345.678", "y"), ("1", "2024-01-05", "1.25", "x")]
KINDS = {"n": "int", "day": "date", "amount": "decimal(6,2)"}


def test_layers(spark, tmp_path):
    got = typed_layer(spark.createDataFrame(ROWS, "n STRING, day STRING, amount STRING, c0 STRING"), KINDS, str(tmp_path / "t"))
    assert [tuple(r) for r in got.account.collect()] == [("n", "int", 5, 1, 1), ("day", "date", 5, 1, 2), ("amount", "decimal(6,2)", 5, 2, 1)]
    assert (got.n_kept, got.n_rejected) == (3, 2)
    assert sorted(map(str, (tuple(r) for r in got.rejected.collect()))) == sorted([str((*ROWS[1], ["n", "day"])), str((*ROWS[3], ["day", "amount"]))])
    kept = got.kept.collect()
    assert got.kept.columns == ["n", "day", "amount", "c0"] and len(kept) == 3
    assert sorted((r.n or 0, str(r.day), r.amount or Decimal(0)) for r in kept) == [(0, "None", 0), (1, "2024-01-05", Decimal("1.25")), (1, "2024-01-05", Decimal("1.25"))]


def test_one_scan(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.range(1_000, numPartitions=4).selectExpr("CASE WHEN id % 10 = 0 THEN 'x' ELSE string(id) END AS n").mapInArrow(counted, "n STRING")
    got = typed_layer(source, {"n": "bigint"}, str(tmp_path / "t"))
    assert seen.value == 1_000 and (got.kept.count(), got.rejected.count()) == (900, 100) == (got.n_kept, got.n_rejected)
    assert seen.value == 1_000 and got.account.first().n_failed == 100


def test_empty_and_untyped(spark, tmp_path):
    none = spark.createDataFrame([], "n STRING, which STRING")
    got = typed_layer(none, {"n": "int"}, str(tmp_path / "e"))
    assert got.kept.count() == got.rejected.count() == 0 and tuple(got.account.first()) == ("n", "int", 0, 0, 0)
    got = typed_layer(spark.createDataFrame([("a", "b")], "n STRING, which STRING"), {}, str(tmp_path / "u"))
    assert [tuple(r) for r in got.kept.collect()] == [("a", "b")] and got.account.count() == 0


def test_clashes(spark, tmp_path):
    df = spark.createDataFrame([("1", "2")], "n STRING, m STRING")
    with pytest.raises(ValueError, match="not exactly one"):
        typed_layer(df, {"k": "int"}, str(tmp_path / "a"))
    with pytest.raises(ValueError, match="not exactly one"):
        typed_layer(df.toDF("n", "n"), {"n": "int"}, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="clash"):
        typed_layer(df, {"n": "int"}, str(tmp_path / "c"), failed_as="m")
