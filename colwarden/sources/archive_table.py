"""Large ZIP archives of CSV entries as tables: written, listed, planned and read in pieces.

Reading goes in two phases, and no row ever holds an archive:

1. `archive_files` lists files without content; `entries_of` reads each one's central directory by range, in tasks: a row an
   entry, with where it lies. An archive that can't be read gives one row with the reason.
2. `entry_rows` plans tasks by the compressed bytes of entries: neighbours in an archive make a split of about `split_bytes`,
   and tasks get whole splits. A task inflates an entry from its range as it reads. `first_headers` needs the first
   kilobytes of an archive's first CSV entry only. An entry is the smallest unit, as deflate can't be entered midway.

`write_archives` writes a table that way, and a manifest: a row an entry with its place and the least and greatest text of
chosen columns (zones). `read_pruned` turns predicates into a filter on the manifest, so entries that can't hold a match are
never opened. Everything is text, as in the raw layer; texts compare by code point, and ISO dates thus by time.

Why predicates are arguments and not pushed by the planner: a Python data source of Spark 4.1 that skips rows by pushed
filters keeps them for later plans of the same loaded table, so that a union of two filters over it, or a read without one
after a read with one, loses rows.

Defined results: null cells are written empty and read back as empty texts; entries of one name are entries each; what an
entry lacks of the asked columns is null; entries without rows, archives without entries and empty files are fine or have a
reason; encrypted entries and methods other than stored and deflate have a reason.
"""

from __future__ import annotations

import csv
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith
from pyspark.sql.types import StructType

from ..functions.scalar import is_csv
from ..plans.contract import CONTRACT_FIELDS, raw_schema
from ..shipping import ship
from .archive import MOST_HEADER_CHARS, BadArchive, capped, clean, rows_of
from .storage import opened

PLACE = "pos INT, entry STRING, method INT, offset LONG, compressed LONG, size LONG, crc LONG"
ENTRY_SCHEMA = f"path STRING, {PLACE}, reason STRING"
HEADER_SCHEMA = "path STRING, entry STRING, fields ARRAY<STRING>, reason STRING, bytes_read LONG"
#: What a local file header begins with, and how it is laid out: at 26 the lengths of its name and its extra field.
LOCAL_HEADER, LOCAL_SIZE = b"PK\3\4", 30
#: Entries of one split at most, and bytes of the first piece that is read of an entry.
SPLIT_ENTRIES, FIRST_PIECE, LARGEST_PIECE = 1_000, 1 << 12, 1 << 20
MANIFEST = "_manifest"


class Counted:
    """A random-access file that counts what is read of it."""

    def __init__(self, file):
        self.file, self.read_bytes = file, 0
        self.seek, self.tell, self.seekable = file.seek, file.tell, lambda: True

    def read(self, n: int = -1) -> bytes:
        got = self.file.read(n) if n >= 0 else self.file.read()
        self.read_bytes += len(got)
        return got


def directory(file) -> list[tuple]:
    """(pos, entry, method, offset, compressed, size, crc, reason) of each entry; reads the end and the directory only."""
    try:
        with zipfile.ZipFile(file) as z:
            found = z.infolist()
    except (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError, ValueError, struct.error) as e:
        raise BadArchive(f"unreadable archive: {e}") from e

    def wrong(i: zipfile.ZipInfo) -> str | None:
        return "encrypted" if i.flag_bits & 1 else None if i.compress_type in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) else f"compression method {i.compress_type}"

    return [(k, i.filename, i.compress_type, i.header_offset, i.compress_size, i.file_size, i.CRC, wrong(i)) for k, i in enumerate(found)]


class EntryStream(io.RawIOBase):
    """An entry's content, inflated from its range as it is read. Raises BadArchive where it is cut or its sum is wrong."""

    def __init__(self, file, method: int, offset: int, compressed: int, crc: int):
        self.file, self.left, self.crc, self.sum, self.piece = file, compressed, crc, 0, FIRST_PIECE
        file.seek(offset)
        head = file.read(LOCAL_SIZE)
        if len(head) < LOCAL_SIZE or head[:4] != LOCAL_HEADER:
            raise BadArchive("no entry where the directory has one")
        self.at = offset + LOCAL_SIZE + sum(struct.unpack("<HH", head[26:30]))
        self.engine = zlib.decompressobj(-zlib.MAX_WBITS) if method == zipfile.ZIP_DEFLATED else None
        self.ready = b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.ready and (not self.engine.eof if self.engine else self.left):
            self.fill(len(target))
        got = self.ready[: len(target)]
        self.ready = self.ready[len(got) :]
        self.sum = zlib.crc32(got, self.sum)
        target[: len(got)] = got
        if not got and self.sum != self.crc:
            raise BadArchive("wrong checksum")
        return len(got)

    def fill(self, most: int) -> None:
        """Make at least one byte ready, or come nearer to the end."""
        tail = self.engine.unconsumed_tail if self.engine else b""
        if not tail and self.left:
            self.file.seek(self.at)
            tail = self.file.read(min(self.piece, self.left))
            self.at, self.left, self.piece = self.at + len(tail), self.left - len(tail), min(4 * self.piece, LARGEST_PIECE)
            if not tail:
                raise BadArchive("cut off")
        try:
            self.ready = self.engine.decompress(tail, max(most, 1)) if self.engine else tail
        except zlib.error as e:
            raise BadArchive(f"unreadable entry: {e}") from e
        if not tail and not self.ready and not self.engine.eof:
            raise BadArchive("cut off")


def text_of(file, place: tuple, strip_bom: bool = False) -> io.TextIOBase:
    """place: method, offset, compressed, crc."""
    raw = io.BufferedReader(EntryStream(file, *place), FIRST_PIECE)
    return io.TextIOWrapper(raw, encoding="utf-8-sig" if strip_bom else "utf-8", errors="ignore", newline="\n")


def archive_files(spark: SparkSession, folder: str, glob: str = "*.zip") -> DataFrame:
    """(path, length) of files at any depth; their content isn't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path", "length")


def entries_of(files: DataFrame) -> DataFrame:
    """A row for each entry of each archive, in archive order by pos; for an unreadable archive one row with the reason."""
    ship(files.sparkSession)

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for path in pdf["path"]:
                try:
                    store, where = opened(path)
                    with store.open_input_file(where) as file:
                        rows = [(path, *r) for r in directory(file)] or [(path, *[None] * 7, "no entries")]
                except (BadArchive, OSError) as e:
                    rows = [(path, *[None] * 7, str(e))]
                yield pd.DataFrame(rows, columns=["path", "pos", "entry", "method", "offset", "compressed", "size", "crc", "reason"]).astype(object).where(lambda d: d.notna(), None)

    return files.select("path").mapInPandas(work, ENTRY_SCHEMA)


def first_headers(entries: DataFrame, strip_bom: bool = False) -> DataFrame:
    """The header of each archive's first CSV entry, as archive_headers gives it, and how many bytes were read for it."""
    ship(entries.sparkSession)
    place = F.struct("entry", "method", "offset", "compressed", "crc", "reason")
    by_path = entries.groupBy("path").agg(F.min_by(F.when(is_csv(F.col("entry")), place), F.when(is_csv(F.col("entry")), F.col("pos"))).alias("first"), F.max(F.when(F.col("entry").isNull(), F.col("reason"))).alias("whole"))

    def header(path: str, entry: str, method: int, offset: int, compressed: int, crc: int) -> tuple:
        read = 0
        try:
            store, where = opened(path)
            with store.open_input_file(where) as raw:
                file = Counted(raw)
                try:
                    first = next(csv.reader(capped(text_of(file, (method, offset, compressed, crc), strip_bom), MOST_HEADER_CHARS)), None)
                finally:
                    read = file.read_bytes
            return (path, entry, [clean(c) for c in first], None, read) if first is not None else (path, None, [], "empty CSV", read)
        except (BadArchive, csv.Error, OSError) as e:
            return path, None, [], f"unreadable CSV: {e}", read

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = [(r.path, None, [], r.reason, 0) if r.reason else header(r.path, r.entry, *map(int, (r.method, r.offset, r.compressed, r.crc))) for r in pdf.itertuples()]
            yield pd.DataFrame(rows, columns=["path", "entry", "fields", "reason", "bytes_read"])

    wrong = F.when(F.col("first").isNull(), F.coalesce("whole", F.lit("no CSV entry"))).otherwise(F.col("first.reason"))
    return by_path.select("path", "first.*", wrong.alias("wrong")).drop("reason").withColumnRenamed("wrong", "reason").mapInPandas(work, HEADER_SCHEMA)


def splits_of(entries: DataFrame, split_bytes: int) -> DataFrame:
    """(path, split, entries): readable CSV entries of an archive, neighbours together, each split of about split_bytes."""
    order = Window.partitionBy("path").orderBy("pos")
    usable = entries.where(is_csv(F.col("entry")) & F.col("reason").isNull())
    before = F.sum("compressed").over(order) - F.col("compressed")
    parts = F.struct(F.floor(before / split_bytes).alias("by_bytes"), F.floor((F.row_number().over(order) - 1) / SPLIT_ENTRIES).alias("by_count"))
    place = F.struct("pos", "entry", "method", "offset", "compressed", "crc")
    return usable.withColumn("split", parts).groupBy("path", "split").agg(F.array_sort(F.collect_list(place)).alias("entries"), F.sum("compressed").alias("bytes"))


def entry_rows(entries: DataFrame, fields: Sequence[str] = CONTRACT_FIELDS, split_bytes: int = 64 << 20, batch: int = 5_000, strip_bom: bool = False, errors_as: str | None = None) -> DataFrame:
    """The rows of every readable CSV entry, cut down to fields, all strings. Each entry is read by its own header.

    An entry that turns out cut or damaged raises; with errors_as, a column of that name, its rows up to the damage stay, and
    a row of nulls has the reason there. Unreadable archives have no entries; ask entries_of for their reasons.
    """
    ship(entries.sparkSession)
    fields = list(fields)
    splits = splits_of(entries, split_bytes)
    total = splits.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]  # planning: one number
    planned = splits.repartitionByRange(max(1, -(-total // split_bytes)), "path", "split")
    names = [*fields, errors_as] if errors_as else fields
    pad = [None] if errors_as else []

    def rows(path: str, places) -> Iterator[list]:
        store, where = opened(path)
        with store.open_input_file(where) as file:
            for p in places:
                try:
                    for r in rows_of(text_of(file, (p["method"], p["offset"], p["compressed"], p["crc"]), strip_bom), fields):
                        yield r + pad
                except (BadArchive, csv.Error) as e:
                    if not errors_as:
                        raise BadArchive(f"{path}, {p['entry']}: {e}") from e
                    yield [None] * len(fields) + [f"{p['entry']}: {e}"]

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        held: list[list] = []
        for pdf in batches:
            for path, places in zip(pdf["path"], pdf["entries"], strict=True):
                for r in rows(path, places):
                    held.append(r)
                    if len(held) == batch:
                        yield pd.DataFrame(held, columns=names, dtype=object)
                        held = []
        if held:
            yield pd.DataFrame(held, columns=names, dtype=object)

    return planned.select("path", "entries").mapInPandas(work, raw_schema(names))


def write_archives(df: DataFrame, folder: str, zones: Sequence[str] = (), rows_per_entry: int = 50_000, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write df as archives of CSV entries, by the tasks that compute it, and return the manifest, which is stored with them.

    An entry has up to rows_per_entry rows, which a task holds at a time; an archive ends once it has archive_bytes. Files carry a
    fresh name, so those of attempts that failed are named by no manifest row. Sort df by the zone columns for narrow zones.
    """
    ship(df.sparkSession)
    names, zones = df.columns, list(zones)
    bounds = "".join(f", `least:{z}` STRING, `most:{z}` STRING, `nulls:{z}` LONG" for z in zones)
    schema = f"path STRING, {PLACE}, rows LONG{bounds}"

    def entry(z: zipfile.ZipFile, nth: int, table) -> list:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import csv as arrow_csv

        content = pa.BufferOutputStream()
        arrow_csv.write_csv(table, content)
        z.writestr(f"part_{nth + 1:05}.csv", content.getvalue().to_pybytes())
        info = z.infolist()[-1]
        found = []
        for name in zones:
            column = table.column(names.index(name))
            ends = pc.min_max(column).as_py()
            found += [ends["min"], ends["max"], column.null_count]
        return [nth, info.filename, info.compress_type, info.header_offset, info.compress_size, info.file_size, info.CRC, table.num_rows, *found]

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, where = opened(folder)
        store.create_dir(where, recursive=True)
        archive = stream = None
        name, nth, held, count = "", 0, [], 0

        def flush():
            nonlocal archive, stream, name, nth, held, count
            if archive is None:
                name, nth = f"part-{uuid.uuid4().hex}.zip", 0
                stream = store.open_output_stream(f"{where}/{name}", compression=None)
                archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
            row = [f"{folder.rstrip('/')}/{name}", *entry(archive, nth, pa.Table.from_batches(held))]
            nth, held, count = nth + 1, [], 0
            if stream.tell() >= archive_bytes:
                close()
            return row

        def close():
            nonlocal archive
            if archive is not None:
                archive.close()
                stream.close()
                archive = None

        rows = []
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, rows_per_entry - count)
                batch, count = batch.slice(part.num_rows), count + part.num_rows
                held.append(part)
                if count == rows_per_entry:
                    rows.append(flush())
        if held:
            rows.append(flush())
        close()  # no row of the manifest leaves before its archive is whole
        if rows:
            types = pa_types()
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=columns)

    def pa_types() -> list:
        import pyarrow as pa

        text, whole, small = pa.string(), pa.int64(), pa.int32()
        return [text, small, text, small, whole, whole, whole, whole, whole, *[text, text, whole] * len(zones)]

    columns = StructType.fromDDL(schema).names
    texts = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in names])
    texts.mapInArrow(work, schema).write.parquet(f"{folder.rstrip('/')}/{MANIFEST}")
    return df.sparkSession.read.parquet(f"{folder.rstrip('/')}/{MANIFEST}")


def read_pruned(spark: SparkSession, folder: str, columns: Sequence[str] = CONTRACT_FIELDS, filters: Sequence[Filter] = (), split_bytes: int = 64 << 20) -> DataFrame:
    """The rows of a folder that write_archives wrote, which pass all filters; entries that can't hold one are never opened.

    filters: those of pyspark.sql.datasource, over text columns. Equality, In, ranges, beginnings and null tests of zone columns
    become a filter on the manifest, which Spark pushes into its scan; every filter is applied to the rows, too, where a null
    cell is an empty text, so null tests choose entries by the manifest and rows by emptiness.
    """
    manifest = spark.read.parquet(f"{folder.rstrip('/')}/{MANIFEST}")
    named = {name.partition(":")[2] for name in manifest.columns if name.startswith("least:")}
    for f in filters:
        if f.attribute[0] in named and (test := may_hold(f)) is not None:
            manifest = manifest.where(test)
    asked = dict.fromkeys([*columns, *(f.attribute[0] for f in filters)])
    rows = entry_rows(manifest.withColumn("reason", F.lit(None).cast("string")), list(asked), split_bytes)
    for f in filters:
        rows = rows.where(passes(f))
    return rows.select([F.col(f"`{c}`") for c in columns])


COMPARE = {GreaterThan: Column.__gt__, GreaterThanOrEqual: Column.__ge__, LessThan: Column.__lt__, LessThanOrEqual: Column.__le__}


def may_hold(f: Filter) -> Column | None:
    """Whether an entry may hold a row that passes f, by its zones; None where they don't tell."""
    least, most, nulls = (F.col(f"`{kind}:{f.attribute[0]}`") for kind in ("least", "most", "nulls"))
    if isinstance(f, IsNull):
        return (nulls > 0) | (least == "")
    if isinstance(f, IsNotNull):
        return most > ""
    values = f.value if isinstance(f, In) else (getattr(f, "value", None),)
    if not values or not all(isinstance(v, str) for v in values):
        return None
    value = values[0]
    if isinstance(f, (EqualTo, In)):
        among = [(least <= v) & (most >= v) for v in values if v != ""]
        empty = [(nulls > 0) | (least == "")] if "" in values else []
        return reduce(Column.__or__, [*among, *empty])
    if isinstance(f, StringStartsWith) and value:
        return (most >= value) & (F.substring(least, 1, len(value)) <= value)
    if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and value:
        return COMPARE[type(f)](most, value)
    if isinstance(f, (LessThan, LessThanOrEqual)) and value:
        return COMPARE[type(f)](least, value) | (nulls > 0)
    return None


def passes(f: Filter) -> Column:
    """f for a row whose null cells are empty texts."""
    cell = F.col(f"`{f.attribute[0]}`")
    if isinstance(f, IsNull):
        return cell == ""
    if isinstance(f, IsNotNull):
        return cell != ""
    if isinstance(f, In):
        return cell.isin(list(f.value))
    if isinstance(f, StringStartsWith):
        return cell.startswith(f.value)
    if isinstance(f, EqualTo):
        return cell == f.value
    if type(f) in COMPARE:
        return COMPARE[type(f)](cell, f.value)
    raise ValueError(f"no such filter here: {type(f).__name__}")
