"""One run from a request to the verdict: submit, wait, download, discover, verify, each once, ending at the first failure."""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import report, verify
from ..plans.contract import CONTRACT_FIELDS, relation
from .archive import BadArchive, header_in
from .jobs import ExportJob, ExportRequest, transport_of

COMPLETE, INCOMPLETE, ENDED = 0, 1, 2


class ExportFailed(RuntimeError):
    """The job ended without a file."""


@dataclass(frozen=True)
class Outcome:
    """status: 0 where all required fields are there, 1 where some are not, 2 where the run ended before, with the reason."""

    status: int
    reason: str | None = None
    path: str | None = None
    summary: DataFrame | None = None


def open_folder(uri: str):
    """(file system, path) of a folder by URI, or by local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def land(job: ExportJob, request: ExportRequest, landing: str) -> str:
    """Run the job; the path of its file in the landing folder. A file that isn't whole is removed."""
    return land_once(job, request, landing, uuid.uuid4().hex)


def land_once(job: ExportJob, request: ExportRequest, landing: str, run: str) -> str:
    """land under the name of a run; if its file is there already, the job isn't submitted again. A file gets its name when it is whole."""
    from pyarrow import fs

    store, folder = open_folder(landing)
    store.create_dir(folder, recursive=True)
    path, part = f"{folder}/export-{run}.zip", f"{folder}/.export-{run}-{uuid.uuid4().hex}.part"
    if store.get_file_info(path).type != fs.FileType.NotFound:
        return path
    if reason := job.fetch_to(request, lambda: store.open_output_stream(part, compression=None)):
        if store.get_file_info(part).type != fs.FileType.NotFound:
            store.delete_file(part)
        raise ExportFailed(reason)
    store.move(part, path)
    return path


def verify_export(spark: SparkSession, job: ExportJob, request: ExportRequest, landing: str, required: Sequence[str] = CONTRACT_FIELDS) -> Outcome:
    """Ask for an export and check the header of its first CSV entry. Whatever fails ends the run; nothing is repeated."""
    try:
        path = land(job, request, landing)
        store, _ = open_folder(landing)
        with store.open_input_file(path) as file:
            entry, fields = header_in(file)
    except (ExportFailed, BadArchive) as e:
        job.say(f"ended: {e}")
        return Outcome(ENDED, str(e))
    found = list(dict.fromkeys(fields))
    if not found:
        job.say("ended: no fields were discovered")
        return Outcome(ENDED, "no fields were discovered", path)
    job.say(f"discovered {len(found)} fields in {entry}")
    summary = verify.summary(relation(spark, list(required)), relation(spark, found))
    complete = summary.first()["all_available"]
    job.say("complete" if complete else "incomplete")
    return Outcome(COMPLETE if complete else INCOMPLETE, None, path, summary)


def main(argv: Sequence[str] | None = None) -> int:
    """Print the progress and the report; the exit status is the outcome's."""
    parser = argparse.ArgumentParser(description="Ask a bulk export service for a sample and verify its columns.")
    parser.add_argument("endpoint")
    parser.add_argument("landing", help="a folder for the download, by URI or path")
    parser.add_argument("--transport", help="module:callable; HTTP if absent")
    options = parser.parse_args(argv)
    job = ExportJob(options.endpoint, transport_of(options.transport))
    outcome = verify_export(SparkSession.builder.getOrCreate(), job, ExportRequest.sample(), options.landing)
    print("\n".join(job.log))
    if outcome.summary is not None:
        print("\n".join(r["line"] for r in report.lines(outcome.summary).collect()))
    return outcome.status


if __name__ == "__main__":
    sys.exit(main())
