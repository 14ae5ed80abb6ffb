"""Scalar expressions over header cells, job documents and dates: built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FINISHED, FAILED, PENDING = "finished", "failed", "pending"


def clean_name(cell: Column) -> Column:
    """Unicode blanks off both ends, then all double quotes off both ends."""
    return F.trim(F.regexp_replace(cell, r"(?U)^\s+|\s+$", ""), F.lit('"'))


def is_csv(entry: Column) -> Column:
    return F.lower(entry).endswith(".csv")


def mentions(name: Column, part: str) -> Column:
    return F.contains(F.lower(name), F.lit(part.lower()))


def begins_with(content: Column, magic: str) -> Column:
    """Whether binary content begins with the bytes that magic gives in upper-case hex; false for null and shorter content."""
    return F.coalesce(F.hex(F.substring(content, 1, len(magic) // 2)) == magic, F.lit(False))


def is_zip(content: Column) -> Column:
    """The magic bytes of an archive."""
    return begins_with(content, "504B")


def head(content: Column, n: int = 100) -> Column:
    """The first bytes of binary content, or characters of text."""
    return F.substring(content, 1, n)


def job_state(status: Column) -> Column:
    """finished, failed or pending; a missing status is pending."""
    low = F.lower(F.coalesce(status, F.lit("")))
    return F.when(low == "finished", FINISHED).when(low.isin("failed", "error"), FAILED).otherwise(PENDING)


def handle(document: Column, key: str) -> Column:
    """A key of a JSON document; null where it is missing."""
    return F.get_json_object(document, f"$.{key}")


def present(value: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(value, F.lit("")) != ""


def window_start(as_of: Column, days: int = 2) -> Column:
    return F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd")


def window_end(as_of: Column) -> Column:
    return F.date_format(as_of, "yyyy-MM-dd")
