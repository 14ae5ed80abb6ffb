"""WARC archives: writing them, and normalising monolithic gzip files.

Crawlers leave archives that are one gzip stream from end to end; a reader must inflate all of it to reach one record. The
normaliser inflates such a file once, as a stream, and writes every record as a gzip member of its own, with a sidecar
index of offsets, so that any record is one seek and one small inflate. Heads and blocks stay byte by byte as they are,
whatever the record's type and whoever wrote it. The same pass tells the digests of response payloads; afterwards a
response whose payload another one holds becomes a revisit of it: members are copied as they are packed, and only those
that turn are inflated again, to keep their HTTP head and all header lines but type, length and block digest.

Files are written by tasks to shared storage (any file system that pyarrow opens by URI), under names that no other task or
attempt uses; the rows that tasks return name the files of the attempts that count. Payloads never leave the task that
holds them: only ids and digests are compared, aggregated partially, so many equal payloads do not meet in one task.
Files that are written here hold a bounded number of records, so a file's decisions fit in one row.

Defined results: a null page is an empty payload; a null url is written as ``about:blank``; of rows with equal payloads the
largest id is the response, of rows with equal ids too just one; a null id is smaller than any, as is a record id that is
not of this writer; a revisit of a null id has a null refers_to. Revisits that an archive brings along stay. An empty table
writes no file. Archives that break off, are damaged or hold a head without a length keep their whole records before that
place, and normalise tells the reason; of damaged gzip the piece of up to 1 MB of text in which the damage shows goes, too. Very long pages are held whole, one at a time for each task. Extra columns do not take part.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import remove, spill, workspace

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_OWN_ID = re.compile(r"<urn:x-page:(-?[0-9]+):[0-9a-f]{8}-[0-9]+>")
RECORDS_PER_FILE, BYTES_PER_FILE = 4_096, 256 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, name: str, url: str | None, payload_digest: str, size: int, payload: bytes, date: str = DATE) -> bytes:
    """One WARC/1.1 record of an HTTP answer."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:x-page:{name}>",
        f"WARC-Target-URI: {' '.join((url or 'about:blank').split())}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return whole("\r\n".join(lines).encode(), block)


def whole(head: bytes, block: bytes) -> bytes:
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisit_of(head: bytes, block: bytes, refers_to: str) -> bytes:
    """The record as a revisit: without its payload, all else of it kept but what tells type, length and digests.

    The payload digest, by which the profile identifies what is revisited, is that of the payload that goes; where the record
    had none the line is new.
    """
    http, end, payload = block.partition(b"\r\n\r\n")
    block = http + end
    new = {b"warc-type": b"revisit", b"content-length": str(len(block)).encode(), b"warc-block-digest": b"sha1:" + digest(block).encode(), b"warc-payload-digest": b"sha1:" + digest(payload).encode()}
    lines, turned, told = [], False, False
    for line in head.split(b"\r\n"):
        name, _, _ = line.partition(b":")
        folded = line[:1] in (b" ", b"\t")  # belongs to the line before
        if not folded and (turned := (kind := name.strip().lower()) in new):
            line, told = name + b": " + new[kind], told or kind == b"warc-payload-digest"
        elif folded and turned:
            continue
        lines.append(line)
    if not told:
        lines.append(b"WARC-Payload-Digest: " + new[b"warc-payload-digest"])
    return whole(b"\r\n".join([*lines, f"WARC-Profile: {PROFILE}".encode(), f"WARC-Refers-To: {refers_to}".encode()]), block)


def head_of(raw: bytes) -> dict[str, str]:
    """Header fields by lower-cased name, without the version line; folded lines are joined by a blank."""
    fields, name = {}, None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name is not None:
            fields[name] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    return fields


class Broken(ValueError):
    """The archive can't be read on from here."""


class Truncated(Broken):
    """The archive ends inside a record or a gzip member."""


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The text of a gzip file of one or more members, piece by piece, each byte inflated once."""
    engine, open_member, most = zlib.decompressobj(31), False, 1 << 20
    for chunk in chunks:
        full = False  # the engine may hold more text than it gave, without input left
        while chunk or full:
            if not open_member and not (chunk := chunk.lstrip(b"\0")):
                break
            open_member = True
            try:
                text = engine.decompress(chunk, most)
            except zlib.error as e:
                raise Broken(f"no gzip: {e}") from e
            full = len(text) == most
            if text:
                yield text
            if engine.eof:
                chunk, full = engine.unused_data, False
                engine, open_member = zlib.decompressobj(31), False
            else:
                chunk = engine.unconsumed_tail
    if open_member:
        raise Truncated("gzip member is not complete")


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(head, block) of each record, as they are. Holds one record at a time."""
    pieces, held = iter(pieces), bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while held[:1] in (b"\r", b"\n") or (not held and fill(1)):
            if held[:1] not in (b"\r", b"\n"):
                break
            del held[:1]
        if not held:
            return
        looked = 0
        while (end := held.find(b"\r\n\r\n", max(0, looked - 3))) < 0:
            looked = len(held)
            if not fill(looked + 1):
                raise Truncated("record head is not complete")
        head = bytes(held[:end])
        told = head_of(head).get("content-length", "")
        if not head.startswith(b"WARC/") or not re.fullmatch("[0-9]+", told):
            raise Broken("record head without version or length")
        size = int(told)
        if not fill(end + 4 + size):
            raise Truncated("record block is not complete")
        yield head, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size]


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """The HTTP head's fields and the payload of a response's or revisit's block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    return head_of(head), payload


def page_id_of(record_id: str | None) -> int | None:
    """The page id in a record id of this writer; null for null pages and for record ids of others."""
    found = _OWN_ID.fullmatch(record_id or "")
    return int(found[1]) if found else None


def storage(folder: str):
    from pyarrow import fs

    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    found, path = fs.FileSystem.from_uri(folder)
    found.create_dir(path, recursive=True)
    return found, path


def chunks_of(stream, size: int = 1 << 20) -> Iterator[bytes]:
    while data := stream.read(size):
        yield data


def rows_as(schema: str, rows: list[tuple]):
    """An Arrow batch of rows by a schema of Spark's string, longs, ints and strings only."""
    import pyarrow as pa

    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [tuple(x.split()) for x in schema.split(", ")]
    cols = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def write_monolithic(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = 1) -> DataFrame:
    """Write every row as a response record, in files of one gzip stream each. (file, n_records) for every file."""
    ship(pages.sparkSession)
    schema = "file string, n_records long"

    def work(batches: Iterator) -> Iterator:
        store, path = storage(folder)
        stream = engine = None
        seq = size = 0
        for batch in batches:
            for ident, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if stream is None or seq >= RECORDS_PER_FILE or size >= BYTES_PER_FILE:
                    if stream is not None:
                        stream.write(engine.flush())
                        stream.close()
                        yield rows_as(schema, [(file, seq)])
                    file, seq, size = f"mono-{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream, engine = store.open_output_stream(f"{path}/{file}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                payload = html.as_py() or b""
                raw = record("response", f"{'null' if ident is None else ident}:{file[5:13]}-{seq}", url, digest(payload), len(payload), payload)
                stream.write(engine.compress(raw))
                seq, size = seq + 1, size + len(raw)
        if stream is not None:
            stream.write(engine.flush())
            stream.close()
            yield rows_as(schema, [(file, seq)])

    source = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("binary"))
    return source.mapInArrow(work, schema)


class Members:
    """A file of one gzip member for each record, and its sidecar index of a JSON line for each."""

    def __init__(self, store, path: str):
        self.out = store.open_output_stream(path, compression=None)
        self.side = store.open_output_stream(f"{path}.idx")
        self.at = 0

    def __enter__(self) -> Members:
        return self

    def __exit__(self, *_) -> None:
        self.out.close()
        self.side.close()

    def add(self, member: bytes, ident: str | None, kind: str | None, told: str | None) -> None:
        self.out.write(member)
        self.side.write(json.dumps({"offset": self.at, "length": len(member), "id": ident, "type": kind, "digest": told}).encode() + b"\n")
        self.at += len(member)


def packed(raw: bytes, level: int) -> bytes:
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(raw) + engine.flush()


def normalise(files: DataFrame, source: str, target: str, level: int = 4) -> DataFrame:
    """Rewrite every file of the folder source that files names, with a member per record, to the folder target.

    (file, seq, id, page_id, digest, reason) for each record, by the new file's name; digest is null for all but HTTP responses.
    A file that breaks off or is damaged keeps the whole records before that place; one more row, without seq, has the reason.
    """
    ship(files.sparkSession)
    schema = "file string, seq int, id string, page_id long, digest string, reason string"

    def records(stream, out: Members, name: str) -> Iterator[tuple]:
        try:
            for seq, (head, block) in enumerate(records_of(inflate(chunks_of(stream)))):
                fields = head_of(head)
                kind, ident = fields.get("warc-type"), fields.get("warc-record-id")
                told = digest(payload_of(block)[1]) if kind == "response" and block.startswith(b"HTTP/") and ident else None
                out.add(packed(whole(head, block), level), ident, kind, told)
                yield name, seq, ident, page_id_of(ident), told, None
        except Broken as e:
            yield name, None, None, None, None, str(e)

    def work(batches: Iterator) -> Iterator:
        store, path = storage(source)
        target_store, target_path = storage(target)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                name = f"norm-{uuid.uuid4().hex}.warc.gz"
                with store.open_input_stream(f"{path}/{file}", compression=None) as stream, Members(target_store, f"{target_path}/{name}") as out:
                    # rows leave as they come: those of an attempt that fails count for nothing
                    found = records(stream, out, name)
                    while rows := list(islice(found, 2048)):
                        yield rows_as(schema, [(*r[:5], f"{file}: {r[5]}" if r[5] else None) for r in rows])

    return files.select("file").mapInArrow(work, schema)


def broken(index: DataFrame) -> DataFrame:
    """(file, reason) for the files of normalise's result that were not read to their end."""
    return index.where("reason IS NOT NULL").select("file", "reason")


def revisits(index: DataFrame) -> DataFrame:
    """(file, again) for every file of index: which of its records repeat another's payload, and whose, as (seq, id)."""
    told = index.where("digest IS NOT NULL")
    last = told.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "file", "seq", "id")).alias("last")).where("n > 1").select("digest", "last")
    last = spill(last, "last")  # a join of two plain shuffles may be split at a hot digest
    again = told.join(last, "digest").where("file <> last.file OR seq <> last.seq").select("file", "seq", F.col("last.id").alias("id"))
    each = index.select("file").distinct().select("file", F.lit(None).cast("int").alias("seq"), F.lit(None).cast("string").alias("id")).unionByName(again)
    return each.groupBy("file").agg(F.collect_list(F.when(F.col("seq").isNotNull(), F.struct("seq", "id"))).alias("again"))


def settle(work_list: DataFrame, source: str, target: str, level: int = 4) -> DataFrame:
    """Copy the normalised files of work_list (file, again) from one folder to another, the records in again as revisits.

    (file, index_file, n_records) of each. Members are copied without being inflated, but for those that become revisits.
    """
    ship(work_list.sparkSession)
    schema = "file string, index_file string, n_records long"

    def work(batches: Iterator) -> Iterator:
        store, path = storage(source)
        target_store, target_path = storage(target)
        for batch in batches:
            for file, again in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                turned = {x["seq"]: x["id"] for x in again}
                name, seq = f"norm-{uuid.uuid4().hex}.warc.gz", -1
                with store.open_input_stream(f"{path}/{file}.idx") as side:
                    entries = side.read().splitlines()
                with store.open_input_stream(f"{path}/{file}", compression=None) as stream, Members(target_store, f"{target_path}/{name}") as out:
                    for seq, entry in enumerate(map(json.loads, entries)):
                        member, kind = stream.read(entry["length"]), entry["type"]
                        if seq in turned:
                            ((head, block),) = records_of([zlib.decompress(member, 31)])
                            member, kind = packed(revisit_of(head, block, turned[seq]), level), "revisit"
                        out.add(member, entry["id"], kind, entry["digest"])
                yield rows_as(schema, [(name, f"{name}.idx", seq + 1)])

    return work_list.select("file", "again").mapInArrow(work, schema)


def read_members(files: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every response and revisit, each reached by its index entry.

    A response's size and digest are those of the payload as read; of this writer's they must be as told in its head.
    Records of other writers have a null page_id, and a null size or digest where a revisit's head tells none.
    """
    ship(files.sparkSession)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def row_of(head: bytes, block: bytes) -> tuple:
        fields, (http, payload) = head_of(head), payload_of(block)
        kind, ident = fields["warc-type"], fields.get("warc-record-id")
        told = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        if kind == "revisit":
            return page_id_of(ident), size, told, kind, page_id_of(fields.get("warc-refers-to"))
        real = digest(payload)
        if (ident or "").startswith("<urn:x-page:") and (len(payload) != size or real != told):
            raise ValueError(f"record {ident} is not as its head tells")
        return page_id_of(ident), len(payload), real, kind, None

    def work(batches: Iterator) -> Iterator:
        store, path = storage(folder)
        for batch in batches:
            for file, index_file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{path}/{index_file}") as side, store.open_input_file(f"{path}/{file}") as source:
                    rows = []
                    for entry in map(json.loads, side.read().splitlines()):
                        if entry["type"] not in ("response", "revisit"):
                            continue
                        source.seek(entry["offset"])
                        ((head, block),) = records_of([zlib.decompress(source.read(entry["length"]), 31)])
                        rows.append(row_of(head, block))
                        if len(rows) == 2048:
                            yield rows_as(schema, rows)
                            rows = []
                    if rows:
                        yield rows_as(schema, rows)

    return files.select("file", "index_file").mapInArrow(work, schema)


def rewrite(files: DataFrame, source: str, folder: str, drop_source: bool = False) -> DataFrame:
    """Normalise the files of the folder source that files names, and turn repeated payloads to revisits. (file, index_file,
    n_records) of the new files in folder. What is written between is removed; with drop_source the folder source too, as
    soon as all its records are stored anew.
    """
    spark, between = files.sparkSession, f"{folder.rstrip('/')}/between-{uuid.uuid4().hex[:12]}"
    n = max(1, files.count())
    index = spill(normalise(files.repartition(n), source, between), "records")
    if drop_source:
        remove(spark, source)
    made = spill(settle(spill(revisits(index), "todo").repartition(n), between, folder), "members")
    remove(spark, between)
    return made


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as monolithic archives, normalise them, and read them back by their indexes."""
    folder = folder or workspace(pages.sparkSession, "warc")
    mono = f"{folder.rstrip('/')}/mono"
    made = rewrite(spill(write_monolithic(pages, mono), "mono"), mono, folder, drop_source=True)
    return read_members(made.repartition(max(1, made.count())), folder)
