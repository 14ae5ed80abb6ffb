"""The export service's job: submit, wait, download, in that order, on the driver.

Tasks may be retried, a request must not be; so no task ever talks to the service. Clock, sleep and transport are given.
"""

from __future__ import annotations

import importlib
import io
import json
import logging
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import BinaryIO, Protocol

# What the service is asked for and how long it is waited for.
AWARD_TYPES = ("A", "B", "C", "D", "IDV_A", "IDV_B", "IDV_B_A", "IDV_B_B", "IDV_B_C", "IDV_C", "IDV_D", "IDV_E")
SUBMIT_TIMEOUT_S, STATUS_TIMEOUT_S, DOWNLOAD_TIMEOUT_S = 60, 30, 60
POLL_INTERVAL_S, MAX_WAIT_MINUTES, SAMPLE_DAYS = 10, 5, 2

#: Bytes of a download that are held at once.
PIECE = 1 << 20


class Transport(Protocol):
    def post(self, url: str, document: Mapping, timeout: float) -> bytes: ...

    def get(self, url: str, timeout: float) -> bytes: ...

    def pieces(self, url: str, timeout: float) -> Iterator[bytes]:
        """What get returns, piece by piece."""


class HttpTransport:
    """The standard library's client; statuses of 400 and more raise."""

    def __init__(self, user_agent: str = "colwarden"):
        self.headers = {"User-Agent": user_agent}

    def post(self, url: str, document: Mapping, timeout: float) -> bytes:
        request = urllib.request.Request(url, json.dumps(document).encode(), self.headers | {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.read()

    def get(self, url: str, timeout: float) -> bytes:
        return b"".join(self.pieces(url, timeout))

    def pieces(self, url: str, timeout: float) -> Iterator[bytes]:
        with urllib.request.urlopen(urllib.request.Request(url, headers=self.headers), timeout=timeout) as r:
            while piece := r.read(PIECE):
                yield piece


def transport_of(spec: str | None, options: Mapping | None = None) -> Transport:
    """The transport that ``module:callable`` makes; HTTP without a spec."""
    if not spec:
        return HttpTransport()
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)(**(options or {}))


@dataclass(frozen=True)
class ExportRequest:
    """What is asked for. Both ends of the date range are sent as they are; the service decides whether they count."""

    start: date
    end: date
    award_types: Sequence[str] = AWARD_TYPES
    agency: tuple[str, str, str] = ("awarding", "toptier", "All")
    date_type: str = "action_date"
    file_format: str = "csv"
    columns: Sequence[str] | None = None  # none: all columns are delivered

    @classmethod
    def sample(cls, as_of: date | None = None, days: int = SAMPLE_DAYS, **options) -> ExportRequest:
        as_of = as_of or date.today()
        return cls(as_of - timedelta(days=days), as_of, **options)

    def document(self) -> dict:
        kind, tier, name = self.agency
        filters = {"prime_award_types": list(self.award_types), "date_type": self.date_type, "date_range": {"start_date": f"{self.start:%Y-%m-%d}", "end_date": f"{self.end:%Y-%m-%d}"}, "agencies": [{"type": kind, "tier": tier, "name": name}]}
        return {"filters": filters, "file_format": self.file_format} | ({"columns": list(self.columns)} if self.columns else {})


@dataclass(frozen=True)
class Handles:
    """Where a job is asked about and where its file will be. Empty after a failed submit, with the reason."""

    status_url: str | None = None
    file_url: str | None = None
    reason: str | None = None


@dataclass(frozen=True)
class Waited:
    ok: bool
    reason: str
    checks: int = 0


@dataclass
class ExportJob:
    endpoint: str
    transport: Transport
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    log: list[str] = field(default_factory=list)

    def say(self, line: str) -> None:
        """Progress, kept in order and given to the logger of this package."""
        self.log.append(line)
        logging.getLogger("colwarden").info(line)

    def submit(self, request: ExportRequest) -> Handles:
        """One request, never repeated. Any failure gives empty handles."""
        try:
            answer = json.loads(self.transport.post(self.endpoint, request.document(), SUBMIT_TIMEOUT_S))
            handles = Handles(answer.get("status_url"), answer.get("file_url"))
        except Exception as e:  # whatever goes wrong in a submit is a failed submit  # noqa: BLE001
            return Handles(reason=f"submit failed: {e}")
        return handles if handles.status_url and handles.file_url else Handles(reason="the answer lacks a status or file address")

    def wait(self, status_url: str | None, max_wait_minutes: float = MAX_WAIT_MINUTES) -> Waited:
        """Ask at once and then every ten seconds, until the job ends or the time is up. A failed check is a pending one."""
        if not status_url:
            return Waited(False, "no status address")
        began, checks = self.clock(), 0
        while self.clock() - began < max_wait_minutes * 60:
            checks += 1
            try:
                status = json.loads(self.transport.get(status_url, STATUS_TIMEOUT_S)).get("status", "").lower()
            except Exception as e:  # noqa: BLE001
                self.say(f"status check failed: {e}")
                status = ""
            self.say(f"check {checks}: {status or 'no status'}")
            if status == "finished":
                return Waited(True, status, checks)
            if status in ("failed", "error"):
                return Waited(False, status, checks)
            self.sleep(POLL_INTERVAL_S)
        return Waited(False, "timed out", checks)

    def download_to(self, file_url: str | None, out: BinaryIO) -> int:
        """Write the file to out as it arrives; its size, or 0 without an address or after any failure."""
        size = 0
        try:
            for piece in self.transport.pieces(file_url, DOWNLOAD_TIMEOUT_S) if file_url else ():
                out.write(piece)
                size += len(piece)
        except Exception as e:  # noqa: BLE001
            self.say(f"download failed: {e}")
            return 0
        return size

    def download(self, file_url: str | None) -> bytes:
        """The whole file; empty without an address or after any failure."""
        out = io.BytesIO()
        return out.getvalue() if self.download_to(file_url, out) else b""

    def fetch_to(self, request: ExportRequest, opener: Callable[[], AbstractContextManager], max_wait_minutes: float = MAX_WAIT_MINUTES) -> str | None:
        """Submit, wait, and download to what opener opens, which happens once the file is there. None, or why the job ended."""
        handles = self.submit(request)
        if not handles.status_url:
            return handles.reason
        self.say("submitted")
        waited = self.wait(handles.status_url, max_wait_minutes)
        if not waited.ok:
            return f"waiting failed: {waited.reason}"
        with opener() as out:
            size = self.download_to(handles.file_url, out)
        self.say(f"downloaded {size} bytes")
        return None if size else "download failed"

    def fetch(self, request: ExportRequest, max_wait_minutes: float = MAX_WAIT_MINUTES) -> tuple[bytes, str | None]:
        """(archive, None), or (empty, why the job ended)."""
        out = io.BytesIO()
        reason = self.fetch_to(request, lambda: nullcontext(out), max_wait_minutes)
        return b"" if reason else out.getvalue(), reason
