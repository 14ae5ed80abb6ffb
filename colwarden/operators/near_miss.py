"""Our extension: names that a missing name may have been meant to be, within a few edits.

Two names within k edits share, of their padded q-grams in one common order, one among the first k * q + 1 of each. So names
meet by an equi-join on those few grams, rarest first, and Spark's banded levenshtein decides. A name so short that all its
grams may be destroyed meets its partners, which are short too, by a shared text with up to k characters left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What pads names: a character that no name should have; where one has it, it only makes candidates.
PAD = "\x01"


def grams(name: Column, q: int) -> Column:
    """The padded q-grams as (gram, nth), nth counting repeats, so that they form a set."""
    padded = F.concat(F.lit(PAD * (q - 1)), name, F.lit(PAD * (q - 1)))
    plain = F.transform(F.sequence(F.lit(1), F.length(padded) - (q - 1)), lambda i: F.substring(padded, i, F.lit(q)))
    earlier = lambda g, i: F.size(F.filter(F.slice(plain, 1, i + 1), lambda h: h == g))
    return F.transform(plain, lambda g, i: F.concat(g, F.lit("\x02"), earlier(g, i).cast("string")))


def left_out(name: Column, k: int) -> Column:
    """Distinct texts that name becomes with 0 to k characters left out."""
    found = F.array(name)
    for _ in range(k):
        shorter = F.transform(found, lambda s: F.transform(F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s)))))
        found = F.array_distinct(F.concat(found, F.flatten(shorter)))
    return found


def near_misses(missing: DataFrame, found: DataFrame, k: int = 2, q: int = 2) -> DataFrame:
    """(field, near, distance): for each name of missing the other names of found within k edits; both have a column field.

    Names count once, null names don't; equal names are no near miss. Distance counts characters inserted, deleted or put
    in another's place. Upper and lower case differ.
    """
    if k < 1 or q < 2:
        raise ValueError("k from 1, q from 2")
    sides = lambda df, wanted: df.select("field", F.lit(wanted).alias("wanted"))
    # one row a name with the sides it is on, so that grams are made and counted once
    names = sides(missing, True).unionByName(sides(found, False)).where(F.col("field").isNotNull()).groupBy("field").agg(F.max("wanted").alias("asked"), F.max(~F.col("wanted")).alias("there"))
    each = names.select("field", F.explode(grams(F.col("field"), q)).alias("gram"))
    counted = each.join(each.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram")
    first = counted.groupBy("field").agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "gram"))), 1, k * q + 1).alias("first"))
    by_gram = first.select("field", F.explode("first.gram").alias("key"))
    # k edits can destroy all grams of two names only if both are at most this long
    short = k * q - q + 1
    by_rest = names.where(F.length("field") <= short).select("field", F.explode(left_out(F.col("field"), k)).alias("rest")).select("field", F.concat(F.lit(PAD * 3), "rest").alias("key"))
    keys = by_gram.unionByName(by_rest).join(names, "field")
    a = keys.where("asked").select("field", "key")
    b = keys.where("there").select(F.col("field").alias("near"), "key")
    differ = (F.col("field") != F.col("near")) & (F.abs(F.length("field") - F.length("near")) <= k)
    pairs = a.join(b, "key").where(differ).select("field", "near").distinct()
    return pairs.withColumn("distance", F.levenshtein("field", "near", k)).where(F.col("distance") >= 0)
