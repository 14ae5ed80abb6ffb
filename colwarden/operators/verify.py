"""Checks of a discovered schema against a contract. Everything maps DataFrames to DataFrames.

Both sides are lists of names, so plans are hash aggregates and semi or anti joins of what Catalyst sees as small
relations. Set operators are used where null names must compare equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import mentions
from ..plans.contract import PROBED_FIELD


def fields_of(df: DataFrame) -> DataFrame:
    """The names of df's columns, as data; none of df's rows is read."""
    return df.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(df.columns)], "field STRING")


def names(relation: DataFrame) -> DataFrame:
    return relation.select("field").distinct()


def missing(required: DataFrame, found: DataFrame) -> DataFrame:
    """Required names that were not found."""
    return required.select("field").subtract(found.select("field"))


def available(required: DataFrame, found: DataFrame) -> DataFrame:
    """Required names that were found."""
    return required.select("field").intersect(found.select("field"))


def related(found: DataFrame, part: str) -> DataFrame:
    """Found names that hold part, whatever the case, in ascending order."""
    return names(found).where(mentions(F.col("field"), part)).orderBy("field")


def has_field(relation: DataFrame, field: str) -> DataFrame:
    """One row: whether the relation holds the field; false for an empty one."""
    return relation.agg(F.coalesce(F.max(F.col("field") == field), F.lit(False)).alias("present"))


def counts(relation: DataFrame) -> DataFrame:
    """Names with and without repeats."""
    return relation.agg(F.count(F.lit(1)).alias("n_listed"), F.count_distinct("field").alias("n_distinct"))


def summary(required: DataFrame, found: DataFrame, probe: str = PROBED_FIELD, related_to: str = "solicitation") -> DataFrame:
    """One row: how many required names there are and how many were found, which are missing, which found names are
    related, whether the probed field is there, and the verdict. An empty contract is met; extra names don't matter.
    """
    # one aggregate over both lists, without a join; null names meet null names
    side = lambda df, want: df.select("field", F.lit(want).alias("want"), F.lit(not want).alias("have"))
    both = side(required, True).unionByName(side(found, False)).groupBy("field").agg(F.max("want").alias("want"), F.max("have").alias("have"))
    gone = F.col("want") & ~F.col("have")
    return both.agg(
        F.count_if("want").alias("total_required"),
        F.count_if(F.col("want") & F.col("have")).alias("available"),
        F.array_sort(F.collect_list(F.when(gone, F.col("field")))).alias("missing"),
        F.coalesce(F.max(F.col("want") & F.col("have") & (F.col("field") == probe)), F.lit(False)).alias("probe_available"),
        F.array_sort(F.collect_list(F.when(F.col("have") & mentions(F.col("field"), related_to), F.col("field")))).alias("related"),
        (F.count_if(gone) == 0).alias("all_available"),
    )
