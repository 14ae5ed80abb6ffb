from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from colwarden.streaming.poll_log import BUCKETS, poll_ends, run_available, watch

SCHEMA = "job STRING, at TIMESTAMP_NTZ, id LONG, status STRING"
BEGUN = datetime(2024, 1, 1)


def at(minutes):
    return BEGUN + timedelta(minutes=minutes)


def follow(spark, folder, delay="10 minutes", forget=None):
    polls = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/polls")
    run_available(poll_ends(polls, "job", "at", "id", "status", F.lit(BEGUN).cast("timestamp_ntz"), 60, delay, forget), f"{folder}/out", f"{folder}/checkpoint")
    return sorted((r["job"], r["state"], r["ended_at"]) for r in spark.read.schema("job STRING, state STRING, ended_at TIMESTAMP_NTZ").parquet(f"{folder}/out").collect())


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/polls")


def test_ends_are_told_once_and_as_soon_as_they_are_final(spark, tmp_path):
    folder = tmp_path.as_uri()
    land(spark, folder, [("a", at(1), 1, "running"), ("a", at(20), 5, "FAILED"), ("b", at(2), 2, "running"), ("c", at(3), 3, None), ("d", None, 9, "finished")])
    land(spark, folder, [("a", at(15), 4, "finished"), ("a", at(15), 3, "error"), ("c", at(16), 7, "finished"), ("c", at(16), 7, "finished")])
    assert follow(spark, folder) == []  # nothing is final before the watermark has passed it
    land(spark, folder, [("b", at(30), 8, "running")])
    assert follow(spark, folder) == [("a", "failed", at(15)), ("c", "finished", at(16))]  # earlier rows came later; of one time the smaller id
    land(spark, folder, [("a", at(31), 10, "finished"), ("b", at(59.5), 11, "running"), ("e", at(59), 12, "running")])
    land(spark, folder, [("b", at(60), 13, "finished"), ("f", at(75), 14, "finished")])
    done = [("a", "failed", at(15)), ("b", "timed out", None), ("c", "finished", at(16)), ("e", "timed out", None)]
    assert [r for r in follow(spark, folder) if r[0] != "f"] == done
    land(spark, folder, [("a", at(200), 16, "finished"), ("g", at(5), 15, "error"), ("h", at(200), 17, "running")])
    # g is late, and so dropped
    assert follow(spark, folder) == sorted([*done, ("f", "timed out", None), ("h", "timed out", None)])


def test_state_goes_after_the_time_to_forget(spark, tmp_path):
    folder = tmp_path.as_uri()
    land(spark, folder, [("a", at(1), 1, "finished")])
    land(spark, folder, [("b", at(150), 2, "running")])
    assert follow(spark, folder, forget=30) == [("a", "finished", at(1)), ("b", "timed out", None)]
    land(spark, folder, [("c", at(151), 3, "running")])
    follow(spark, folder, forget=30)
    land(spark, folder, [("a", at(152), 4, "finished"), ("c", at(170), 5, "running")])
    assert follow(spark, folder, forget=30).count(("a", "timed out", None)) == 1  # forgotten, so told again: keep it above the lateness


def test_calls_and_states_are_by_the_bucket_not_by_the_job(spark, tmp_path):
    folder, first, n = tmp_path.as_uri(), 2**60, 5 * BUCKETS
    jobs = spark.range(n + 1).select(F.when(F.col("id") < n, F.col("id") + first).alias("job"), "id")
    begun = F.lit(BEGUN).cast("timestamp_ntz")
    minute = lambda k: begun + F.make_dt_interval(mins=F.lit(k))
    status = F.when(F.col("id") % 3 == 0, "finished").when(F.col("id") % 3 == 1, "error")
    jobs.select("job", minute(5).alias("at"), F.col("id"), status.alias("status")).write.parquet(f"{folder}/polls")
    jobs.select("job", minute(5).alias("at"), F.lit(None).cast("long").alias("id"), F.when(F.col("id") == 6, "failed").alias("status")).write.mode("append").parquet(f"{folder}/polls")
    jobs.limit(1).select("job", minute(200).alias("at"), F.col("id"), F.lit("running").alias("status")).write.mode("append").parquet(f"{folder}/polls")
    polls = spark.readStream.schema("job LONG, at TIMESTAMP_NTZ, id LONG, status STRING").parquet(f"{folder}/polls")
    query = run_available(poll_ends(polls, "job", "at", "id", "status", begun, 60, "10 minutes"), f"{folder}/out", f"{folder}/checkpoint")
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= BUCKETS
    got = {r["job"]: (r["state"], r["ended_at"]) for r in spark.read.parquet(f"{folder}/out").collect()}
    want = {first + k if k < n else None: (("finished", at(5)), ("failed", at(5)), ("timed out", None))[k % 3] for k in range(n + 1)}
    assert got == want | {first + 6: ("failed", at(5))}  # a null order comes first


class Bucket:
    """A state as Spark hands it over."""

    kept, timer, hasTimedOut = None, None, False  # noqa: N815
    exists = property(lambda self: self.kept is not None)
    getOption = property(lambda self: self.kept)  # noqa: N815

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.now

    def update(self, value):
        self.kept = value

    def remove(self):
        self.kept = None

    def setTimeoutTimestamp(self, ms):  # noqa: N802
        self.timer = ms


def test_told_jobs_are_forgotten_though_rows_of_others_go_on():
    follow, bucket = watch(1_000_000, 500_000), Bucket()

    def batch(now, *rows):
        bucket.now, bucket.timer = now, None
        polls = pd.DataFrame(rows, columns=["job", "micros", "place", "state"])
        return [tuple(r) for done in follow((0,), iter([polls]), bucket) for r in done.values.tolist()]

    assert batch(0, ("a", 3_000, 1, "finished"), ("b", 1_000_000, 2, "pending"), (None, 2_500, 3, "failed")) == []
    assert bucket.timer == 2  # Spark calls when the watermark is above: at 3, when 2.5 and 3 are final
    assert batch(3, ("a", 2_000, 9, "failed")) == [("a", "failed", 2_000), (None, "failed", 2_500)]
    assert bucket.timer == 999
    assert batch(1_400, ("a", 1_000_000, 4, "pending"), (None, 1_000_000, 4, "pending")) == [("b", "pending", 1_000_000)]  # poll_ends names it timed out
    assert bucket.timer == 1_499
    assert batch(1_500, ("a", 1_000_000, 5, "pending"), ("c", 1_000_000, 5, "pending")) == [("c", "pending", 1_000_000)]
    assert bucket.kept[4] == ["c"] and bucket.timer == 1_500
    assert batch(1_501, ("a", 1_000_000, 6, "pending")) == [("a", "pending", 1_000_000)]
    bucket.hasTimedOut = True
    assert batch(1_502) == [] and not bucket.exists
