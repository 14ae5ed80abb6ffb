"""Comparison of two field lists, and the final ordered list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.contract import PROBED_FIELD


def only_in(left: DataFrame, right: DataFrame, *but: str) -> DataFrame:
    """Names of left that right lacks, other than those named."""
    found = left.select("field").subtract(right.select("field"))
    return found.where(~F.col("field").isin(*but) | F.col("field").isNull()) if but else found


def common(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("field").intersect(right.select("field"))


def difference(etl: DataFrame, contract: DataFrame, pending: str = PROBED_FIELD) -> DataFrame:
    """One row: both lists' lengths, repeats counted, their common names, those of one list only, and whether the ETL list
    meets the contract, the pending field aside.
    """
    lists = etl.select("field", F.lit(1).alias("e"), F.lit(0).alias("c")).unionByName(contract.select("field", F.lit(0).alias("e"), F.lit(1).alias("c")))
    per = lists.groupBy("field").agg(F.sum("e").alias("e"), F.sum("c").alias("c"))
    lacking = (F.col("e") == 0) & (F.coalesce(F.col("field"), F.lit("")) != pending)
    return per.agg(
        F.coalesce(F.sum("e"), F.lit(0)).alias("etl_fields"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("contract_fields"),
        F.count_if((F.col("e") > 0) & (F.col("c") > 0)).alias("common_fields"),
        F.array_sort(F.collect_list(F.when(F.col("c") == 0, F.col("field")))).alias("etl_only"),
        F.array_sort(F.collect_list(F.when(lacking, F.col("field")))).alias("contract_only"),
        (F.count_if(lacking) == 0).alias("compatible"),
    )


def final_list(relation: DataFrame, separator: str = ", ") -> DataFrame:
    """One row: how many names there are, and the names joined in order."""
    return relation.agg(F.count(F.lit(1)).alias("n_fields"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "field"))), lambda x: x["field"]), separator).alias("fields"))


def ordered(relation: DataFrame) -> DataFrame:
    return relation.orderBy("pos")
