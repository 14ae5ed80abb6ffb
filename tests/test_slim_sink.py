"""The slim sink: windows replaced whole, or not at all."""

import pytest
from pyspark.sql import functions as F

from colwarden.shipping import ship
from colwarden.sources.slim_sink import SlimSink, first_period, load_window, newest, read_slim, vacuum

FIELDS = ("key", "day", "period")


def rows(spark, tag, days):
    return spark.createDataFrame([(f"{tag}{i}", d, 1, "x") for i, d in enumerate(days)], "key STRING, day STRING, period INT, extra STRING")


def held(spark, path, *window):
    return sorted(((r.key, r.day) for r in read_slim(spark, path, *window).collect()), key=str)


def test_windows(spark, tmp_path):
    path = str(tmp_path / "slim")
    days = ["2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01", None, "soon", "2023-12-31"]
    load_window(rows(spark, "a", days), path, "day", fields=FIELDS)
    assert held(spark, path) == sorted(((f"a{i}", d) for i, d in enumerate(days)), key=str)
    february = rows(spark, "b", ["2024-02-10", "2024-03-10", None])
    for _ in range(2):  # a window loaded twice gives the same table
        load_window(february, path, "day", "2024-02-01", "2024-03-01", FIELDS)
        assert [k for k, _ in held(spark, path)] == ["a0", "a3", "a4", "a5", "a6", "b0"]
    assert [k for k, _ in held(spark, path, "2024-02-01", "2024-03-01")] == ["b0"]
    # an open start holds the undated
    load_window(rows(spark, "c", [None]), path, "day", None, "2024-01-01", FIELDS)
    assert [k for k, _ in held(spark, path)] == ["a0", "a3", "b0", "c0"]
    # a window without rows empties it
    load_window(rows(spark, "d", []), path, "day", "2024-02-01", None, FIELDS)
    assert [k for k, _ in held(spark, path)] == ["a0", "c0"]
    assert vacuum(path) > 0 and vacuum(path) == 0
    assert [k for k, _ in held(spark, path)] == ["a0", "c0"]
    assert read_slim(spark, path).columns == list(FIELDS)


def test_failed_load_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "slim")
    load_window(rows(spark, "a", ["2024-01-01", "2024-02-01"]), path, "day", fields=FIELDS)
    before = held(spark, path), newest(path), sorted((tmp_path / "slim" / "data").iterdir())

    def breaks(batches):
        for b in batches:
            yield b
        raise RuntimeError("broken source")

    many = spark.range(20_000, numPartitions=4).select(F.col("id").cast("string").alias("key"), F.lit("2024-01-01").alias("day"), F.lit(1).alias("period"))
    with pytest.raises(Exception, match="broken source"):
        load_window(many.mapInArrow(breaks, many.schema), path, "day", fields=FIELDS)
    assert before == (held(spark, path), newest(path), sorted((tmp_path / "slim" / "data").iterdir()))


def test_a_task_that_fails_while_it_writes(spark, tmp_path):
    """Some tasks have written their files when another one fails: the files go with the load."""
    ship(spark)
    spark.dataSource.register(SlimSink)
    path = str(tmp_path / "slim")
    # without the shuffle of load_window, so that the failure lies in the writing stage
    late = spark.range(8, numPartitions=4).select(F.lit("2024-01").alias("p"), F.when(F.col("id") < 6, F.col("id")).otherwise(F.raise_error(F.lit("late failure")).cast("long")).alias("v"))
    with pytest.raises(Exception, match="late failure"):
        late.write.format("slim_sink").mode("append").option("path", path).save()
    assert newest(path) == (0, None) and not list((tmp_path / "slim").rglob("*.parquet"))
    with pytest.raises(FileNotFoundError):
        read_slim(spark, path)


def test_bounds_and_columns(spark, tmp_path):
    assert [first_period(d, u) for d, u in (("2024-02-01", "month"), ("2024-01-01", "year"), ("2024-02-29", "day"), (None, "day"))] == ["2024-02", "2024", "2024-02-29", None]
    for day, unit in (("2024-02-02", "month"), ("2024-02-01", "year"), ("20240201", "day")):
        with pytest.raises(ValueError, match="begins on"):
            first_period(day, unit)
    path = str(tmp_path / "slim")
    load_window(rows(spark, "a", ["2024-01-01"]), path, "day", fields=FIELDS)
    with pytest.raises(Exception, match="other columns"):
        load_window(rows(spark, "a", ["2024-01-01"]), path, "day", fields=("key", "day"))
    assert len(held(spark, path)) == 1


def test_hot_period_is_spread(spark, tmp_path):
    path = str(tmp_path / "slim")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_window(spark.range(4_000).select(F.col("id").cast("string").alias("key"), F.lit("2024-01-01").cast("date").alias("day")), path, "day", fields=("key", "day"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [f[2] for f in newest(path)[1]["files"]]
    assert sum(sizes) == 4_000 and len(sizes) == 4 and max(sizes) < 2_000
