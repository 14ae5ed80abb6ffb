"""What keys JSON texts deliver, and of what kind, checked against a contract like that of columns.

Texts become variants, whose keys are exploded with their kinds and counted in one pass with partial sums; only (key, kind)
pairs are shuffled. Kinds: integer, number, text, boolean, null, object, array, and for what JSON texts do not give, other.

Defined results: a row with a null field counts documents by state: object, null (no text), unreadable (not JSON, or a key
twice in one object), and other document (JSON, but no object). Keys are compared exactly; only the outermost ones count.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("integer", "number", "text", "boolean", "null", "object", "array")


def kind_of(value: Column) -> Column:
    """The kind of a variant. Whole numbers of more digits than a long has are integers too."""
    name = F.schema_of_variant(value)
    plain = {"BIGINT": "integer", "DOUBLE": "number", "FLOAT": "number", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}
    out = F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
    out = out.when(name.rlike(r"^DECIMAL\(\d+,\s*0\)$"), "integer").when(name.startswith("DECIMAL"), "number")
    for spark_name, kind in plain.items():
        out = out.when(name == spark_name, kind)
    return F.coalesce(out.otherwise("other"), F.lit("null"))


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """(field, kind, n): how many documents have the field with that kind; with a null field, documents by their state."""
    text = df.select(F.col(f"`{column}`").alias("doc"))
    parsed = text.select("doc", F.try_parse_json("doc").alias("v"))
    keyed = parsed.select("doc", "v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")).try_cast("map<string,variant>").alias("m"))
    state = F.when(F.col("doc").isNull(), "null").when(F.col("v").isNull(), "unreadable").when(F.col("m").isNull(), "other document").otherwise("object")
    pair = lambda field, kind: F.struct(field.cast("string").alias("field"), kind.alias("kind"))
    keys = F.transform(F.map_entries("m"), lambda e: pair(e["key"], kind_of(e["value"])))
    pairs = F.concat(F.array(pair(F.lit(None), state)), F.coalesce(keys, F.array().cast("array<struct<field:string,kind:string>>")))
    return keyed.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.kind").agg(F.count(F.lit(1)).alias("n"))


def json_contract(found: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """(field, kind, fitting, other_kind, absent) for each wanted field, from what json_fields found; absent counts objects
    without the field. One aggregate; an empty contract gives no rows.
    """
    spark = found.sparkSession
    if not wanted:
        return spark.createDataFrame([], "field STRING, kind STRING, fitting LONG, other_kind LONG, absent LONG")
    if odd := sorted(set(wanted.values()) - set(KINDS)):
        raise ValueError(f"unknown kinds: {', '.join(odd)}")
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    name, kind = F.col("field"), F.col("kind")
    sums = [total(name.isNull() & (kind == "object")).alias("objects")]
    for k, (field, want) in enumerate(wanted.items()):
        sums += [total((name == field) & (kind == want)).alias(f"fit{k}"), total((name == field) & (kind != want)).alias(f"odd{k}")]
    rows = [
        F.struct(F.lit(f).alias("field"), F.lit(w).alias("kind"), F.col(f"fit{k}").alias("fitting"), F.col(f"odd{k}").alias("other_kind"), (F.col("objects") - F.col(f"fit{k}") - F.col(f"odd{k}")).alias("absent"))
        for k, (f, w) in enumerate(wanted.items())
    ]
    return found.where(name.isNull() | name.isin(*wanted)).agg(*sums).select(F.inline(F.array(*rows)))
