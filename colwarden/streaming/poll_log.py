"""Poll logs as a stream: each job's end, told once, as soon as no earlier row can come.

A job is followed from `begun` for `minutes`. Its end is the first row, by time and then order, whose status ends a job. The
end is final when the watermark has passed it: rows that come later are late by the stream's own measure. A job without an
end before the limit is timed out when the watermark has passed the limit. Both waits are event-time timers, so nothing is
looked at before it is due, and a restart from the checkpoint goes on where it was.

A call of Python for every job in every batch would cost far more than the work in it. So jobs are followed by the bucket,
BUCKETS of them by hash, each with one state and the timer of its next job due: a call handles a bucket's rows of a batch, an
Arrow batch at a time. A state holds a job's earliest end so far, then only its name, as it was told. `forget_minutes` after
the limit that goes, too; rows of the job that come later than that would tell it again, so keep it above the lateness of
the source. BUCKETS is fixed by a checkpoint's states; for more than some ten thousand jobs a bucket, raise it.

Defined results: null times never count, as a stream can't order them; null statuses are pending; repeated rows change
nothing; jobs of a null key are one job; rows that are late by the watermark are dropped, so `delay` must cover the disorder;
of rows of one time, a null order comes first. Keys are of a simple type (they are kept as text, binary ones as hex).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalar import PENDING, job_state
from ..shipping import BATCH_ROWS, ship

TIMED_OUT = "timed out"
BUCKETS = 1_024
STATE = "job ARRAY<STRING>, micros ARRAY<LONG>, place ARRAY<LONG>, state ARRAY<STRING>, told ARRAY<STRING>"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def watch(deadline: int, forget: int | None) -> Callable:
    """What follows a bucket of jobs. Times are microseconds; a row that ends nothing in time has that of the limit."""

    def follow(key, polls: Iterator, bucket: GroupState) -> Iterator:
        import pandas as pd

        *columns, told = bucket.getOption or ([], [], [], [], [])
        waiting = pd.DataFrame(dict(zip(("job", "micros", "place", "state"), columns, strict=True)))
        now = bucket.getCurrentWatermarkMs()
        changed = False
        if not bucket.hasTimedOut:
            for pdf in polls:
                new = pdf.loc[~pdf["job"].isin(told), waiting.columns]
                if len(new):
                    changed = True
                    waiting = (pd.concat([waiting, new]) if len(waiting) else new).sort_values(["micros", "place"], kind="stable").drop_duplicates("job")
        ripe = (waiting["micros"] <= now * 1000).to_numpy(bool)
        done, waiting = waiting[ripe], waiting[~ripe]
        if forget is not None and told and now * 1000 >= deadline + forget:
            told, changed = [], True
        if len(done):
            told, changed = told + _texts(done["job"]), True
            yield done[["job", "state", "micros"]]
        if changed and not told and waiting.empty:
            bucket.remove()
        elif changed:
            bucket.update((_texts(waiting["job"]), waiting["micros"].tolist(), waiting["place"].tolist(), waiting["state"].tolist(), told))
        due = waiting["micros"].tolist() + ([deadline + forget] if told and forget is not None else [])
        if due:
            bucket.setTimeoutTimestamp(max(-(-min(due) // 1000) - 1, now, 1))  # Spark waits until the watermark is above it

    return follow


def _texts(names) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in names]


def poll_ends(log: DataFrame, job: str, at: str, order: str, status: str, begun: Column, minutes: int, delay: str, forget_minutes: int | None = None) -> DataFrame:
    """(job, state, ended_at) once for each job of a streaming log; ended_at is null for what is timed out. begun: a constant timestamp."""
    ship(log.sparkSession)
    deadline = log.sparkSession.range(1).select(F.unix_micros(begun.cast("timestamp"))).first()[0] + minutes * 60_000_000
    time = F.col(f"`{at}`").cast("timestamp")
    kind = log.schema[job].dataType
    name = F.hex(F.col(f"`{job}`")) if isinstance(kind, T.BinaryType) else F.col(f"`{job}`").cast("string")
    micros, state = F.unix_micros(time), job_state(F.col(f"`{status}`"))
    end = F.when(state != PENDING, F.least(micros, F.lit(deadline))).otherwise(F.lit(deadline))
    place = F.coalesce(F.col(f"`{order}`").cast("long"), F.lit(-(2**63)))
    rows = log.where(F.col(f"`{at}`").isNotNull()).select(F.pmod(F.xxhash64(name), F.lit(BUCKETS)).alias("bucket"), name.alias("job"), time.alias("time"), end.alias("micros"), place.alias("place"), state.alias("state"))
    follow = watch(deadline, None if forget_minutes is None else forget_minutes * 60_000_000)
    ends = rows.withWatermark("time", delay).groupBy("bucket").applyInPandasWithState(follow, "job STRING, state STRING, micros LONG", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    late = F.col("micros") >= deadline
    back = F.unhex("job") if isinstance(kind, T.BinaryType) else F.col("job").cast(kind)
    return ends.select(back.alias(job), F.when(late, TIMED_OUT).otherwise(F.col("state")).alias("state"), F.when(~late, F.timestamp_micros("micros")).cast(log.schema[at].dataType).alias("ended_at"))


def run_available(ends: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write what a stream has by now as Parquet, each row exactly once, and stop. Call it again to go on from the checkpoint."""
    spark = ends.sparkSession
    own = {PROVIDER: ROCKS}  # states may outgrow memory; the query keeps its settings from its start
    if spark.conf.get(BATCH, None) == str(BATCH_ROWS):  # set by ship() for long texts; polls are short
        own[BATCH] = "10000"
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        query = ends.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    query.awaitTermination()
    return query
