"""Checks of archives as they land, and replay of poll logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import FAILED, FINISHED, PENDING, job_state
from ..plans.contract import CONTRACT_FIELDS
from ..sources.archive import archive_headers, check_headers

_BINARY = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def landing_checks(spark: SparkSession, folder: str, required: Sequence[str] = CONTRACT_FIELDS, files_per_trigger: int = 100) -> DataFrame:
    """A stream of one verdict per archive that lands in folder. Stateless, so it needs no watermark."""
    files = spark.readStream.format("binaryFile").schema(_BINARY).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return check_headers(archive_headers(files), required)


def first_ends(log: DataFrame, job: str, at: str, order: str, status: str) -> DataFrame:
    """(job, state, ended_at) by the first status that ends a job, in order of time and then order; state pending and no
    time for jobs that did not end. One aggregate with partial sums, whatever the length of a job's log.
    """
    state = job_state(F.col(status))
    ends: Column = state != PENDING
    first = F.min_by(F.when(ends, F.struct(state.alias("state"), F.col(at).alias("at"))), F.when(ends, F.struct(at, order)))
    return log.groupBy(job).agg(first.alias("first")).select(job, F.coalesce("first.state", F.lit(PENDING)).alias("state"), F.col("first.at").alias("ended_at"))


def within_limit(ends: DataFrame, begun: Column, minutes: float) -> DataFrame:
    """ends, where what ended after the limit counts as timed out."""
    late = F.col("ended_at") >= begun + F.make_dt_interval(mins=F.lit(int(minutes)))
    return ends.withColumn("state", F.when(late | F.col("ended_at").isNull(), "timed out").otherwise(F.col("state")))
