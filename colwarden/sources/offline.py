"""A stand-in for the export service: answers requests from rows that it makes, without a network."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator, Mapping
from datetime import date, timedelta

from ..plans.contract import CONTRACT_FIELDS

FIRST_DAY, ROWS = date(2025, 9, 20), 700


class OfflineTransport:
    """Keeps to the request: award types and both ends of the date range. Rows are dealt to `entries` CSV entries."""

    def __init__(self, pending: int = 0, broken: bool = False, entries: int = 1):
        self.pending, self.broken, self.entries, self.requests, self.file = pending, broken, entries, [], b""

    def post(self, url: str, document: Mapping, timeout: float) -> bytes:
        self.requests.append(document)
        if self.broken:
            raise ConnectionError("the service is down")
        span, types = document["filters"]["date_range"], document["filters"]["prime_award_types"]
        parts = [io.StringIO() for _ in range(self.entries)]
        for out in parts:
            out.write(",".join(f'"{f}"' for f in (*CONTRACT_FIELDS, "solicitation_procedures_code")) + "\n")
        for i in range(ROWS):
            day, kind = f"{FIRST_DAY + timedelta(days=i % 7):%Y-%m-%d}", "ABCD"[i % 4]
            if span["start_date"] <= day <= span["end_date"] and kind in types:
                row = {"award_id_piid": f"AW{i:04}", "action_date": day, "award_type": kind, "federal_action_obligation": f"{i * 10.25:.2f}", "transaction_description": '"line one\nline ""two"""'}
                parts[i % self.entries].write(",".join(row.get(f, "") for f in CONTRACT_FIELDS) + ",\n")
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for nth, out in enumerate(parts, 1):
                z.writestr(f"awards_{nth}.csv", out.getvalue())
        self.file = packed.getvalue()
        return json.dumps({"status_url": f"{url}/status", "file_url": f"{url}/file"}).encode()

    def get(self, url: str, timeout: float) -> bytes:
        if url.endswith("/file"):
            return self.file
        self.pending -= 1
        return json.dumps({"status": "running" if self.pending >= 0 else "Finished"}).encode()

    def pieces(self, url: str, timeout: float) -> Iterator[bytes]:
        whole = self.get(url, timeout)
        yield from (whole[at : at + 10_000] for at in range(0, len(whole), 10_000))
