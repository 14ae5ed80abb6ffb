"""What the operators of this subpackage share: shared storage, fresh column names and the word rule."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_folders: list[str] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, a temporary one in local mode, and
    an error on a cluster, whose executors could not reach it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return jvm_dir.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="colwarden-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
        _folders.append(root)
    return root


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path in the shared storage. It is removed when the Python driver ends."""
    path = f"{shared_root(spark).rstrip('/')}/colwarden-{name}-{uuid.uuid4().hex[:12]}"
    _folders.append(path)
    return path


@atexit.register
def _sweep() -> None:
    spark = SparkSession.getActiveSession()
    while _folders:
        path = _folders.pop()
        if path.startswith("file:"):
            shutil.rmtree(path.removeprefix("file:").replace("///", "/"), ignore_errors=True)
        elif spark is not None:
            with suppress(Exception):  # the session may be ending; one folder that stays must not keep the others
                remove(spark, path)


def spill(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet to shared storage and read it back. Lost executors lose nothing of it.

    The tasks that compute df write it: as many as its scan has splits, or as adaptive execution makes of its shuffle by
    size. So tasks stay of one size when the data grow.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """spill(make()); tables and folders that were made on the way are removed as soon as the result is whole."""
    before = len(_folders)
    out = spill(make(), name)
    for path in _folders[before:-1]:
        remove(out.sparkSession, path)
    del _folders[before:-1]
    return out


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df has no column of, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def n_words(text: Column | str) -> Column:
    """Words of a text as a long; 0 for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def small(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches cut to a few rows each, so that Python objects are held for those only."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slices(batches: Iterator, column: int = -1, rows: int = 256, size: int = 4 << 20) -> Iterator:
    """Arrow batches cut to at most so many rows, and to at most so many bytes of a text column or else a single row."""
    import pyarrow.compute as pc

    for batch in batches:
        widths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = total = 0
        for k, width in enumerate(widths):
            if k > at and (k - at == rows or total + width > size):
                yield batch.slice(at, k - at)
                at, total = k, 0
            total += width
        if at < len(widths):
            yield batch.slice(at)


def offsets_of(lengths: list[int]):
    """The Arrow offsets buffer of values with these lengths."""
    import numpy as np
    import pyarrow as pa

    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch of texts over 2 GB")
    return pa.py_buffer(ends.astype(np.int32))


def int_lists(values: list[bytes]):
    """A column of array<int> from int32 values as bytes."""
    import pyarrow as pa

    flat = pa.py_buffer(b"".join(values))
    child = pa.Array.from_buffers(pa.int32(), flat.size // 4, [None, flat])
    kind = pa.list_(pa.field("element", pa.int32(), False))
    return pa.ListArray.from_buffers(kind, len(values), [None, offsets_of([len(v) // 4 for v in values])], children=[child])


def byte_column(values: list[bytes], kind: str = "binary"):
    """A column of binary, or of strings given in UTF-8; nothing is decoded."""
    import pyarrow as pa

    buffers = [None, offsets_of([len(v) for v in values]), pa.py_buffer(b"".join(values))]
    return pa.Array.from_buffers(pa.string() if kind == "string" else pa.binary(), len(values), buffers)
