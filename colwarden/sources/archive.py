"""ZIP archives with CSV entries, decoded in tasks.

Spark has no ZIP reader, and its CSV reader renames repeated headers, eats a byte order mark and cuts quoted line feeds, so
headers are parsed in Python: one row per archive, streamed out of its first CSV entry up to the end of the first record.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.contract import CONTRACT_FIELDS, raw_schema
from ..shipping import ship

HEADER_SCHEMA = "path STRING, entry STRING, fields ARRAY<STRING>, reason STRING"
#: A header of more characters than this is refused, as is any quoted cell of an archive that never ends.
MOST_HEADER_CHARS = 1 << 22


class BadArchive(ValueError):
    """No header can be read; the text says why."""


def csv_entries(file: BinaryIO) -> list[zipfile.ZipInfo]:
    """The CSV entries of an archive, in archive order; entries of one name are several."""
    if file.read(2) != b"PK":
        raise BadArchive("not a ZIP archive")
    file.seek(0)
    try:
        found = [i for i in zipfile.ZipFile(file).infolist() if i.filename.lower().endswith(".csv")]
    except (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError) as e:
        raise BadArchive(f"unreadable archive: {e}") from e
    if not found:
        raise BadArchive("no CSV entry")
    return found


def open_entry(file: BinaryIO, entry: zipfile.ZipInfo, strip_bom: bool = False) -> io.TextIOBase:
    """An entry as text, inflated as it is read. Bytes that aren't UTF-8 are dropped; lines end at line feeds only."""
    try:
        return io.TextIOWrapper(zipfile.ZipFile(file).open(entry), encoding="utf-8-sig" if strip_bom else "utf-8", errors="ignore", newline="\n")
    except (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError) as e:
        raise BadArchive(f"unreadable archive: {e}") from e


def rows_of(text: io.TextIOBase, fields: Sequence[str]) -> Iterator[list[str | None]]:
    """The records after the header, cut down to fields by the header of this entry; what it lacks is null."""
    reader = csv.reader(text)
    header = [clean(c) for c in next(reader, [])]
    at = [header.index(f) if f in header else -1 for f in fields]
    for r in reader:
        if r:
            yield [r[k] if 0 <= k < len(r) else None for k in at]


def capped(text: io.TextIOBase, most: int) -> Iterator[str]:
    """Lines, until more than so many characters were read."""
    left = most
    while line := text.readline(left + 1):
        left -= len(line)
        if left < 0:
            raise BadArchive("header too long")
        yield line


def clean(cell: str) -> str:
    return cell.strip().strip('"')


def header_of(content: bytes, strip_bom: bool = False) -> tuple[str, list[str]]:
    """header_in for an archive in memory."""
    return header_in(io.BytesIO(content), strip_bom)


def header_in(file: BinaryIO, strip_bom: bool = False) -> tuple[str, list[str]]:
    """(entry, names in order, repeats kept) of the first CSV entry; no more of the file is read than that takes."""
    entry = csv_entries(file)[0]
    text = open_entry(file, entry, strip_bom)
    try:
        first = next(csv.reader(capped(text, MOST_HEADER_CHARS)), None)
    except (csv.Error, OSError, EOFError, zipfile.BadZipFile) as e:
        raise BadArchive(f"unreadable CSV: {e}") from e
    if first is None:
        raise BadArchive("empty CSV")
    return entry.filename, [clean(c) for c in first]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of archive files. A row holds a whole file, which bounds a file to what a task can hold; Spark makes no
    row of an empty file.
    """
    return spark.read.format("binaryFile").load(path).select("path", "content")


def archive_headers(archives: DataFrame, strip_bom: bool = False) -> DataFrame:
    """(path, entry, fields, reason) for every archive; fields is empty where reason tells why nothing could be read."""
    ship(archives.sparkSession)

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    entry, fields = header_of(bytes(content or b""), strip_bom)
                    rows.append((path, entry, fields, None))
                except BadArchive as e:
                    rows.append((path, None, [], str(e)))
            yield pd.DataFrame(rows, columns=["path", "entry", "fields", "reason"])

    return archives.select("path", "content").mapInPandas(work, HEADER_SCHEMA)


def discovered(headers: DataFrame) -> DataFrame:
    """(source, entry, field): the distinct names of each archive."""
    return headers.select(F.col("path").alias("source"), "entry", F.explode(F.array_distinct("fields")).alias("field"))


def check_headers(headers: DataFrame, required: Sequence[str] = CONTRACT_FIELDS) -> DataFrame:
    """Each archive against the contract, as a projection: works on streams too. An unreadable archive does not pass."""
    want = F.array(*[F.lit(f) for f in required]) if required else F.array().cast("array<string>")
    gone = F.array_sort(F.array_except(want, "fields"))
    return headers.select("path", "entry", F.size(F.array_distinct("fields")).cast("long").alias("n_fields"), gone.alias("missing"), (F.col("reason").isNull() & (F.size(gone) == 0)).alias("all_available"), "reason")


def archive_rows(archives: DataFrame, fields: Sequence[str] = CONTRACT_FIELDS, batch: int = 5_000, strip_bom: bool = False) -> DataFrame:
    """The rows of every CSV entry of every archive, cut down to fields, all strings; what an entry lacks is null.

    Each entry is read by its own header. Of columns with one name the first counts. Rows shorter than the header end in nulls; an unreadable archive raises.
    """
    ship(archives.sparkSession)
    fields = list(fields)

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                file = io.BytesIO(bytes(content or b""))
                rows: list[list[str | None]] = []
                for r in (r for entry in csv_entries(file) for r in rows_of(open_entry(file, entry, strip_bom), fields)):
                    rows.append(r)
                    if len(rows) == batch:
                        yield pd.DataFrame(rows, columns=fields, dtype=object)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=fields, dtype=object)

    return archives.select("path", "content").mapInPandas(work, raw_schema(fields))
