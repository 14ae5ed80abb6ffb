"""Mixing sources to target weights by repetition rates.

Words are summed per source (partially before the shuffle, so a source with a third of all rows costs no more than any
other), targets follow from weights and a cap, and every document is taken floor(rate) times plus once more if its own
seeded draw falls under the fraction of the rate. No document sees another, so the second pass is a map.

Defined results: a null text has size 0; null is a source of its own, last in order; a source of size 0 has target 0 and
rate 0; very long texts count whole; rows with the same id and text share a draw, so a repeated row gets the same number of
copies as its twin, and rows of one id or of none with different texts are drawn each on their own; equal source sizes are
told apart by name; an empty table gives an empty result. Columns of the input whose names clash with new ones keep theirs, as inner names are made fresh.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, n_words, spill

#: Up to so many sources the table of rates is broadcast (under 100 bytes each); beyond, it is joined by a shuffle.
BROADCAST_SOURCES = 50_000


def draw(id_col: Column, text_col: Column, seed: str) -> Column:
    """In [0, 1), by 52 bits of an MD5 of seed, id and the text's MD5: the same on every run, engine and partitioning."""
    own = F.coalesce(F.md5(text_col.cast("binary")), F.lit("null"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"), own).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code point order, null last, get the weights in turn and divide share times all words by weight. None gets
    more than cap times its own words; what is over is divided again among the rest. In order of cap per weight the
    capped sources come first, so running sums give that fixed point without a loop: source k is capped while its cap per
    weight is under the level that results when all before it are capped.
    """
    if share > cap:
        raise ValueError("share must not exceed cap: no mix could reach it")
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = total.withColumn("weight", w).withColumn("at", F.row_number().over(order)).withColumn("bound", F.col("source_size") * F.lit(float(cap)))
    everything, before = Window.partitionBy(), Window.orderBy(F.col("bound") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level).withColumn("free", F.col("bound") >= F.col("level") * F.col("weight"))
    final = F.min(F.when(F.col("free"), F.struct(F.col("bound") / F.col("weight"), F.col("at"), F.col("level")))).over(everything)["level"]
    return levels.withColumn("final", final).select(
        "source", "source_size", F.least("bound", F.coalesce(F.col("final") * F.col("weight"), F.col("bound"))).alias("target")
    )


def repetitions(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, dict[str, str]]:
    """docs with four more columns; the dict names them by size, source_size, target and copies."""
    size, source_size, target, copies = names = fresh(docs, "size", "source_size", "target", "copies")
    sized = docs.withColumn(size, n_words(text_col))
    rates = spill(source_targets(sized.select(F.col(source_col).alias("source"), F.col(size).alias("size")), weights, share, cap), "rates")
    key, ss, t = fresh(sized, "mix_key", source_size, target)
    rates = rates.toDF(key, ss, t)
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    joined = sized.join(rates, sized[source_col].eqNullSafe(rates[key]))
    rate = F.when(F.col(ss) > 0, F.col(t) / F.col(ss)).otherwise(F.lit(0.0))
    n = F.floor(rate) + (draw(F.col(id_col), F.col(text_col), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn(copies, n).drop(key), dict(zip(("size", "source_size", "target", "copies"), names, strict=True))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: docs' own columns, each document as often as it is taken."""
    taken, names = repetitions(docs, **options)
    own = [F.col(f"`{c}`") for c in docs.columns]
    (nth,) = fresh(taken, "nth")
    return taken.select(*own, F.explode(F.array_repeat(F.lit(0), F.col(names["copies"]).cast("int"))).alias(nth)).select(*own)
