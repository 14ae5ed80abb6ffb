"""Text for people, from the one-row results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def verdict(all_available: str = "all_available") -> Column:
    return F.when(F.col(all_available), F.lit("all required fields are available")).otherwise(F.lit("required fields are missing"))


def lines(summary: DataFrame) -> DataFrame:
    """One column, line: a rule, the counts, one line for each missing and related name, and the verdict, in order."""
    listed = lambda title, col: F.when(F.size(col) > 0, F.concat(F.array(F.lit(title)), F.transform(col, lambda f: F.concat(F.lit("  - "), f)))).otherwise(F.array(F.lit(f"{title} none")))
    head = F.array(F.repeat(F.lit("="), 70), F.format_string("available: %d of %d", "available", "total_required"))
    body = F.concat(head, listed("missing:", "missing"), listed("related:", "related"), F.array(verdict()))
    return summary.select(F.posexplode(body).alias("pos", "line")).orderBy("pos").select("line")


def markdown(summary: DataFrame, title: str = "Field verification") -> str:
    """A small report document. Collects the summary's one row."""
    r = summary.first()
    parts = [f"# {title}", "", f"- required fields: {r['total_required']}", f"- available: {r['available']}", f"- verdict: {'complete' if r['all_available'] else 'incomplete'}", ""]
    for name in ("missing", "related"):
        parts += [f"## {name.capitalize()}", "", *([f"- `{f}`" for f in r[name]] or ["none"]), ""]
    return "\n".join(parts)
