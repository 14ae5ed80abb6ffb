"""Folders that driver and executors share, and files in them by URI."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

_folders: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder in local mode, and an error on a cluster."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = "file://" + tempfile.mkdtemp(prefix="colwarden-")
    _folders.append(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path in the shared storage. It is removed when the Python driver ends, on storage other than local only
    while the session is there.
    """
    path = f"{shared_root(spark).rstrip('/')}/colwarden-{name}-{uuid.uuid4().hex[:12]}"
    _folders.append(path)
    return path


def opened(uri: str):
    """(file system, path) of a file or folder by URI, or by local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri) if re.match(r"\w+:/", uri) else f"file://{uri}")


@atexit.register
def _sweep() -> None:
    spark = SparkSession.getActiveSession()
    for path in reversed(_folders):
        with suppress(Exception):  # one folder that stays must not keep the others
            if path.startswith("file:"):
                shutil.rmtree(re.sub("^file:/+", "/", path), ignore_errors=True)
            elif spark is not None:
                where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
