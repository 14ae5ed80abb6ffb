"""The slim table as a sink with its own commit: loads by windows of time that replace what they load, whole or not at all.

Tasks write Parquet files of one period each (a day, month or year) below `data/<load>`; the commit adds a version file that
lists the files of the table from then on: those of the version before whose periods lie outside the window, and the new
ones. So a window loaded twice gives the same table, readers see one version whole, and a failed load is deleted and listed
nowhere. Files that no version needs any more stay for readers under way, until `vacuum`.

Defined results: rows without a date, or with a text that is no date, are undated, and belong to loads without a start. A
window without rows empties it. Rows outside the window are not loaded. Two loads that begin from one version: the second
to commit fails. (Between that check and the new version lies a moment; run loads of one table one after another.)
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from ..operators.slim import slim
from ..plans.contract import CONTRACT_FIELDS
from ..shipping import ship
from .storage import opened

#: Formats of periods, and what makes a period its first day.
UNITS = {"day": ("yyyy-MM-dd", ""), "month": ("yyyy-MM", "-01"), "year": ("yyyy", "-01-01")}
UNDATED = ""
VERSIONS, DATA = "_versions", "data"


@dataclass
class Landed(WriterCommitMessage):
    files: list  # [period, name below data, rows]


def newest(path: str) -> tuple[int, dict | None]:
    """The number and content of the newest version; (0, None) where there is none."""
    from pyarrow import fs

    store, where = opened(path)
    listed = store.get_file_info(fs.FileSelector(f"{where}/{VERSIONS}", allow_not_found=True))
    found = sorted(f.path for f in listed if f.path.endswith(".json"))
    if not found:
        return 0, None
    with store.open_input_file(found[-1]) as file:
        return int(posixpath.basename(found[-1]).removesuffix(".json")), json.loads(file.read())


def inside(period: str, start: str | None, end: str | None) -> bool:
    return (start is None or period >= start) and (end is None or period < end)


class SlimWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, start: str | None, end: str | None):
        self.path, self.schema, self.start, self.end = path, schema.json(), start, end
        self.load = uuid.uuid4().hex
        self.base = newest(path)[0]

    def write(self, iterator: Iterator) -> Landed:
        """Batches come sorted by period, so one file is open at a time; names are fresh for each attempt."""
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, where = opened(self.path)
        folder = f"{where}/{DATA}/{self.load}"
        store.create_dir(folder, recursive=True)
        files: list = []
        stream = writer = None

        def close() -> None:
            if writer is not None:
                writer.close()
                stream.close()

        for batch in iterator:
            runs, begin = pc.run_end_encode(batch.column(0)), 0
            for period, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                rows = batch.slice(begin, end - begin).drop_columns([batch.schema.names[0]])
                begin = end
                if not files or files[-1][0] != period:
                    close()
                    name = f"{self.load}/{uuid.uuid4().hex}.parquet"
                    stream = store.open_output_stream(f"{where}/{DATA}/{name}", compression=None)
                    writer = pq.ParquetWriter(stream, rows.schema)
                    files.append([period, name, 0])
                writer.write_batch(rows)
                files[-1][2] += rows.num_rows
        close()
        return Landed(files)

    def commit(self, messages: list) -> None:
        store, where = opened(self.path)
        number, before = newest(self.path)
        if number != self.base:
            raise RuntimeError(f"another load committed version {number} since version {self.base}")
        if before and before["schema"] != json.loads(self.schema):
            raise RuntimeError("the table has other columns; load its whole range into a new folder")
        old = [f for f in before["files"] if not inside(f[0], self.start, self.end)] if before else []
        new = [f for m in messages if m is not None for f in m.files]
        version = {"schema": json.loads(self.schema), "window": [self.start, self.end], "files": sorted(old + new)}
        store.create_dir(f"{where}/{VERSIONS}", recursive=True)
        part = f"{where}/{VERSIONS}/{self.load}.part"
        with store.open_output_stream(part, compression=None) as file:
            file.write(json.dumps(version).encode())
        store.move(part, f"{where}/{VERSIONS}/{number + 1:010}.json")

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        store, where = opened(self.path)
        folder = f"{where}/{DATA}/{self.load}"
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class SlimSink(DataSource):
    """Options: path, and start and end, the first period of the window and the first one after it. The first column of what
    is written is its period.
    """

    @classmethod
    def name(cls) -> str:
        return "slim_sink"

    def writer(self, schema: StructType, overwrite: bool) -> SlimWriter:
        return SlimWriter(self.options["path"], StructType(schema.fields[1:]), self.options.get("start"), self.options.get("end"))


def first_period(day: str | None, unit: str) -> str | None:
    """The period that begins on an ISO date; a date midway in one raises."""
    if day is None:
        return None
    begin = UNITS[unit][1]
    if date.fromisoformat(day).isoformat() != day or not day.endswith(begin):
        raise ValueError(f"no {unit} begins on {day}")
    return day.removesuffix(begin) if begin else day


def load_window(df: DataFrame, path: str, on: str, start: str | None = None, end: str | None = None, fields: Sequence[str] = CONTRACT_FIELDS, unit: str = "month") -> None:
    """Replace the rows of the window from start (included) to end (excluded), ISO dates, by those that df has there.

    on: the field with the date: a date, a timestamp or a text. An open window has no bound on that side.
    Periods spread over tasks by their rows, so that a period with many rows is written by several.
    """
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(SlimSink)
    first, last = first_period(start, unit), first_period(end, unit)
    rows = slim(df, fields)
    day = F.col(f"`{on}`")
    if isinstance(rows.schema[on].dataType, (DateType, TimestampType, TimestampNTZType)):  # typed bounds reach the scan
        bound = lambda text: F.lit(text).cast(rows.schema[on].dataType)
        if start is not None:
            rows = rows.where(day >= bound(start))
        if end is not None:
            rows = rows.where((day < bound(end)) | day.isNull())
    period: Column = F.coalesce(F.date_format(day.try_cast("date"), UNITS[unit][0]), F.lit(UNDATED))
    name = "period"
    while name in map(str.lower, fields):
        name += "_"
    rows = rows.select(period.alias(name), *[F.col(f"`{f}`") for f in fields])
    for test in [F.col(name) >= first] * (first is not None) + [F.col(name) < last] * (last is not None):
        rows = rows.where(test)
    spread = rows.repartitionByRange(F.col(name), F.xxhash64(*[F.col(f"`{f}`") for f in fields])).sortWithinPartitions(name)
    writer = spread.write.format("slim_sink").mode("append").option("path", path)
    for key, value in (("start", first), ("end", last)):
        writer = writer if value is None else writer.option(key, value)
    writer.save()


def read_slim(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The newest version of the table; with bounds (ISO dates) only files of periods that may hold rows from start up to end."""
    _, version = newest(path)
    if version is None:
        raise FileNotFoundError(f"no load was committed to {path}")
    schema = StructType.fromJson(version["schema"])
    # a period is the beginning of its days' dates; its length tells its first day
    begins = {len(UNDATED): "", 10: ""} | {len(day): begin for day, begin in (("2000", UNITS["year"][1]), ("2000-01", UNITS["month"][1]))}
    asked = [f[1] for f in version["files"] if (start is None or f[0] != UNDATED and f[0] >= start[: len(f[0])]) and (end is None or f[0] + begins[len(f[0])] < end)]
    if not asked:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{DATA}/{name}" for name in asked])


def vacuum(path: str) -> int:
    """Delete data files that the newest version does not list, and say how many; only while no load and no reader is under way."""
    from pyarrow import fs

    store, where = opened(path)
    _, version = newest(path)
    live = {f"{where}/{DATA}/{f[1]}" for f in version["files"]} if version else set()
    gone = [f.path for f in store.get_file_info(fs.FileSelector(f"{where}/{DATA}", allow_not_found=True, recursive=True)) if f.is_file and f.path not in live]
    for name in gone:
        store.delete_file(name)
    return len(gone)
