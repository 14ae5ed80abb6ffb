"""Parquet footers as data: names, types, row counts and nulls of tables and files, without reading a row.

`table_profile` asks Spark, whose reader answers counts from the footers of a table (aggregate push-down), in any store that
Spark reads. `file_footers` reads the footer of each file in tasks, for stores that Arrow reads too: a row for each column
and row group. `type_problems` checks every file of it against a contract of names and types.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ..shipping import ship
from .storage import opened

PROFILE_SCHEMA = "source STRING, pos INT, field STRING, type STRING, n_rows LONG, n_null LONG"
FOOTER_SCHEMA = "path STRING, pos INT, field STRING, type STRING, row_group INT, n_rows LONG, n_null LONG, bytes LONG, reason STRING"
#: What Spark says of a footer that lacks null counts.
NO_NULL_COUNT = "Number of nulls not set"


def footer_counts(spark: SparkSession, path: str, pushed: bool = True) -> DataFrame:
    """One row: n, and n<i> for each flat column, how many cells hold a value. Of a session of its own, in which Spark's
    second reader of Parquet answers counts from footers; not pushed, the columns are read.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", str(pushed).lower())
    table = own.read.parquet(path)
    flat = [(i, f.name) for i, f in enumerate(table.schema) if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    named = table.select([F.col(f"`{n}`") for _, n in flat])
    return named.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{n}`")).alias(f"n{i}") for i, n in flat])


def table_profile(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(source, pos, field, type, n_rows, n_null) for each column of each table (name to path); one small job a table. n_null
    is null for nested columns, whose footers count cells of several levels. Where a writer left the null counts of a column
    out, as some do in files without rows, that table's flat columns are read instead.
    """
    out = []
    for source, path in tables.items():
        try:
            got = footer_counts(spark, path).first().asDict()
        except Exception as e:  # its class differs between ways to connect
            if NO_NULL_COUNT not in str(e):
                raise
            got = footer_counts(spark, path, pushed=False).first().asDict()
        for i, f in enumerate(spark.read.parquet(path).schema):
            out.append((source, i, f.name, f.dataType.simpleString(), got["n"], got["n"] - got[f"n{i}"] if f"n{i}" in got else None))
    return spark.createDataFrame(out, PROFILE_SCHEMA)


def file_footers(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """A row for each column of each row group of each file at any depth; for files that are no Parquet, or can't be opened,
    one row with the reason. A file without row groups gives its columns with a null row_group. n_null is null where the
    writer left it out, and for nested columns; bytes are those stored. Only footers are read. Files of no bytes are not
    there, as Spark lists none.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path")

    names = StructType.fromDDL(FOOTER_SCHEMA).names

    def rows(path: str) -> list[tuple]:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        try:
            store, where = opened(path)
            with store.open_input_file(where) as file:
                footer = pq.read_metadata(file)
            fields = footer.schema.to_arrow_schema()
            types = [from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString() for f in fields]
        except (OSError, pa.ArrowException, TypeError, ValueError) as e:
            return [(path, *[None] * 7, f"no footer: {str(e).splitlines()[0]}")]
        groups = [footer.row_group(g) for g in range(footer.num_row_groups)]
        found = []
        for g, group in enumerate(groups):
            leaves: dict[str, list] = {}
            for c in (group.column(k) for k in range(group.num_columns)):
                leaves.setdefault(c.path_in_schema.split(".")[0], []).append(c)
            for i, f in enumerate(fields):
                mine = leaves.get(f.name, [])
                told = mine[0].statistics if len(mine) == 1 and mine[0].path_in_schema == f.name else None
                found.append((path, i, f.name, types[i], g, group.num_rows, told.null_count if told and told.has_null_count else None, sum(c.total_compressed_size for c in mine), None))
        return found or [(path, i, f.name, types[i], None, 0, 0, 0, None) for i, f in enumerate(fields)]

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for path in pdf["path"]:
                yield pd.DataFrame(rows(path), columns=names).astype(object).where(lambda d: d.notna(), None)

    return files.mapInPandas(work, FOOTER_SCHEMA)


def type_problems(found: DataFrame, wanted: Mapping[str, str], by: str = "path") -> DataFrame:
    """(by, field, problem) for each wanted field that a file (or source) of found lacks or has with another type. found:
    file_footers or table_profile. No rows: the contract is met. A file without a footer lacks everything.
    """
    want = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(t).alias("want")) for f, t in wanted.items()]).cast("array<struct<field:string,want:string>>")
    asked = found.select(by).distinct().select(by, F.inline(want))
    have = found.where(F.col("field").isin(*wanted)).groupBy(by, "field").agg(F.array_sort(F.collect_set("type")).alias("types"))
    problem = F.when(F.col("types").isNull(), F.lit("missing")).when(F.col("types") != F.array("want"), F.concat(F.lit("type "), F.array_join("types", " and "), F.lit(", not "), F.col("want")))
    return asked.join(have, [by, "field"], "left").select(by, "field", problem.alias("problem")).where(F.col("problem").isNotNull())


