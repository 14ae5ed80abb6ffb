"""The slim table: a wide source cut down to the contract's columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.contract import CONTRACT_FIELDS, DATE_FIELDS, INT_FIELDS, MONEY_FIELDS


class MissingFields(ValueError):
    """The source lacks required columns."""

    def __init__(self, fields: Sequence[str]):
        super().__init__(f"missing required fields: {', '.join(fields)}")
        self.fields = list(fields)


def slim(df: DataFrame, fields: Sequence[str] = CONTRACT_FIELDS) -> DataFrame:
    """The contract's columns in its order. Names must be equal, case included, whatever the session says of case; a pure
    projection, so the scan reads no other column. Of columns of one name the first counts. Raises MissingFields before
    anything runs.
    """
    first = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    if gone := [f for f in fields if f not in first]:
        raise MissingFields(gone)
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select([F.col(f"c{first[f]}").alias(f) for f in fields])


def typed(df: DataFrame) -> DataFrame:
    """Our extension: dates, numbers and amounts where the name tells so; text that does not convert becomes null."""
    kinds = dict.fromkeys(INT_FIELDS, "int") | dict.fromkeys(MONEY_FIELDS, "decimal(20,2)") | dict.fromkeys(DATE_FIELDS, "date")
    return df.select([F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def write_slim(df: DataFrame, path: str, fields: Sequence[str] = CONTRACT_FIELDS, partition_by: Sequence[str] = ()) -> None:
    slim(df, fields).write.partitionBy(*partition_by).parquet(path)
