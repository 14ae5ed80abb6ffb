"""A typed layer with an account of what did not convert, in one pass over the source.

One job casts, counts and writes: counts are metrics observed on the way, and rows go to one of two folders, those whose
every cell converted as typed rows, the others as the texts that came, with the names of the fields that failed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ACCOUNT_SCHEMA = "field STRING, kind STRING, n_rows LONG, n_null LONG, n_failed LONG"


@dataclass(frozen=True)
class TypedLayer:
    kept: DataFrame  # typed rows
    rejected: DataFrame  # rows as they came, and the array of failed fields under the asked name
    account: DataFrame  # a row for each typed field: rows, nulls, failed casts
    n_kept: int
    n_rejected: int


def typed_layer(df: DataFrame, kinds: Mapping[str, str], path: str, failed_as: str = "failed_fields") -> TypedLayer:
    """Write df below path, which must be new, with the columns that kinds names cast to its types.

    A null cell is no failure. Columns of one name are told apart by place; a typed name that df lacks, or has twice, raises,
    as does failed_as where df has it. An empty df gives empty layers and an account of zeros.
    """
    names = df.columns
    if wrong := [n for n in kinds if names.count(n) != 1]:
        raise ValueError(f"not exactly one column of the name: {', '.join(wrong)}")
    if failed_as in names or len(set(map(str.lower, names))) < len(names):
        raise ValueError("names clash; rename columns first")
    spark = df.sparkSession
    cells = df.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: names.index(n) for n in kinds}
    cast = {n: F.col(f"c{i}").try_cast(kinds[n]) for n, i in at.items()}
    fails = {n: F.col(f"c{at[n]}").isNotNull() & cast[n].isNull() for n in kinds}
    which = F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in fails.items()])).cast("array<string>") if kinds else F.array().cast("array<string>")
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n")]
    for k, n in enumerate(kinds):
        counts += [F.count_if(F.col(f"c{at[n]}").isNull()).alias(f"null{k}"), F.count_if(fails[n]).alias(f"failed{k}")]
    made = cells.withColumn("which", which)
    counts.append(F.count_if(F.size("which") > 0).alias("rejected"))
    good = F.size("which") == 0
    typed = F.struct(*[cast.get(n, F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])
    raw = F.struct(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    rows = made.observe(seen, *counts).select(good.alias("kept"), F.when(good, typed).alias("typed"), F.when(~good, raw).alias("raw"), "which")
    rows.write.partitionBy("kept").parquet(path)
    got = seen.get or {}
    written = spark.read.schema(rows.schema).parquet(path)
    kept = written.where("kept").select("typed.*")
    rejected = written.where("NOT kept").select("raw.*", F.col("which").alias(failed_as))
    total, bad = got.get("n", 0), got.get("rejected", 0)
    lines = [(n, kind, total, got.get(f"null{k}", 0), got.get(f"failed{k}", 0)) for k, (n, kind) in enumerate(kinds.items())]
    return TypedLayer(kept, rejected, spark.createDataFrame(lines, ACCOUNT_SCHEMA), total - bad, bad)
