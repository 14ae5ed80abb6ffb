"""spark.read.format("bulk_export"): rows of a bulk export, as a Python data source.

Options: endpoint; transport, a ``module:callable`` that makes the transport (HTTP if absent); landing, the folder for
downloads, shared by driver and executors; columns, a comma-separated list (the contract if absent); as_of, start, end as
ISO dates; award_types, comma-separated.

A loaded table is one job: the first plan submits it and lands its file, under a name of this load, and every later action
reads what has landed. The file stays in the landing folder, which is the caller's to remove (`storage.workspace` gives one
that goes with the driver). Tasks read the landed file only, one for each CSV entry, and inflate it as they go.

`exported` narrows the request by filters of action_date, and applies them to the rows as well, as whether the service counts
the ends isn't known. They are arguments and not pushed by the planner, because a Python data source of Spark 4.1 keeps pushed
filters for later plans of the same loaded table, which would lose rows. A source has no hook for column pruning, so name the
columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..plans.contract import CONTRACT_FIELDS, raw_schema
from ..shipping import ship
from .archive import csv_entries, open_entry, rows_of
from .archive_table import passes
from .jobs import AWARD_TYPES, ExportJob, ExportRequest, transport_of
from .landed import land_once, open_folder


class BulkExport(DataSource):
    def __init__(self, options: dict):
        super().__init__(options)
        self.run = uuid.uuid4().hex  # of this load; plans get a copy of the source that keeps it

    @classmethod
    def name(cls) -> str:
        return "bulk_export"

    def schema(self) -> StructType:
        named = self.options.get("columns")
        return raw_schema([c.strip() for c in named.split(",")] if named else CONTRACT_FIELDS)

    def reader(self, schema: StructType) -> DataSourceReader:
        return BulkExportReader(schema, dict(self.options), self.run)


class Landed(InputPartition):
    """The nth CSV entry of a landed archive."""

    def __init__(self, path: str, nth: int):
        self.path, self.nth = path, nth


class BulkExportReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict, run: str):
        self.fields, self.options, self.run = schema.names, options, run
        sample = ExportRequest.sample(date.fromisoformat(options["as_of"]) if options.get("as_of") else None)
        self.start = date.fromisoformat(options["start"]) if options.get("start") else sample.start
        self.end = date.fromisoformat(options["end"]) if options.get("end") else sample.end

    def partitions(self) -> list[Landed]:
        if self.start > self.end:
            return []
        types = self.options.get("award_types")
        request = ExportRequest(self.start, self.end, [t.strip() for t in types.split(",")] if types else AWARD_TYPES)
        transport = transport_of(self.options.get("transport"), json.loads(self.options.get("transport_options", "{}")))
        path = land_once(ExportJob(self.options["endpoint"], transport), request, self.options["landing"], self.run)
        store, _ = open_folder(self.options["landing"])
        with store.open_input_file(path) as file:
            return [Landed(path, nth) for nth in range(len(csv_entries(file)))]

    def read(self, partition: Landed) -> Iterator[tuple]:
        if not isinstance(partition, Landed):
            return
        store, _ = open_folder(self.options["landing"])
        with store.open_input_file(partition.path) as file:
            yield from map(tuple, rows_of(open_entry(file, csv_entries(file)[partition.nth]), self.fields))


def narrowed(filters: Sequence[Filter], start: date, end: date) -> tuple[date, date]:
    """The range of dates that can pass all filters of action_date; values that are no ISO dates say nothing."""
    day = timedelta(days=1)
    for f in filters:
        if f.attribute != ("action_date",):
            continue
        try:
            values = [date.fromisoformat(str(v)) for v in (f.value if isinstance(f, In) else (getattr(f, "value", ""),))]
        except ValueError:
            continue
        if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual)):
            start = max(start, min(values) + day * isinstance(f, GreaterThan))
        if isinstance(f, (EqualTo, In, LessThan, LessThanOrEqual)):
            end = min(end, max(values) - day * isinstance(f, LessThan))
    return start, end


def exported(spark: SparkSession, filters: Sequence[Filter] = (), **options: str) -> DataFrame:
    """A load of bulk_export with these options, its request narrowed by the filters, which its rows pass. The columns must have those of the filters."""
    ship(spark)
    spark.dataSource.register(BulkExport)
    asked = BulkExportReader(StructType([]), options, "")
    start, end = narrowed(filters, asked.start, asked.end)
    rows = spark.read.format("bulk_export").options(**options | {"start": start.isoformat(), "end": end.isoformat()}).load()
    for f in filters:
        rows = rows.where(passes(f))
    return rows
