"""Connected components of a link table by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, spill


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, label) for every node of links (a, b); label is the smallest node that can be reached.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller neighbours too, and is written to
    shared storage; the rounds end when nothing changes, after about log n of them. A hub costs a row per link, and its
    rows may be split by adaptive execution. Null nodes and loops are left out.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, mark = spill(now, name), None
    while True:
        now = settled(partial(_round, now), name)
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("label")))


def _round(now: DataFrame) -> DataFrame:
    both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written before they are joined: a join of two plain shuffles may be split where a node is a hub
    low = spill(both.groupBy("a").agg(F.min("b").alias("low")), "low")
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
    large = spill(large, "large")
    low = spill(large.groupBy("a").agg(F.min("b").alias("low")), "low")
    return large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("x")).select("x.*").where("a > b").distinct()
