import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from colwarden.shipping import ship
from colwarden.sources.bulk_export import BulkExport, exported, narrowed
from colwarden.sources.jobs import AWARD_TYPES, ExportJob, ExportRequest
from colwarden.sources.landed import ExportFailed, land, main, verify_export
from colwarden.sources.offline import OfflineTransport
from colwarden.plans.contract import CONTRACT_FIELDS
from colwarden.queries import packed
from colwarden.streaming.landing import first_ends, within_limit


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s


class Script:
    """Answers status checks from a list; the last answer repeats. An exception in it is raised."""

    def __init__(self, *answers, submit=None, file=b"PK"):
        self.answers, self.submit, self.file, self.posts, self.gets = list(answers), submit, file, [], []

    def post(self, url, document, timeout):
        self.posts.append((url, document, timeout))
        if isinstance(self.submit, Exception):
            raise self.submit
        return json.dumps(self.submit if self.submit is not None else {"status_url": "s", "file_url": "f"}).encode()

    def get(self, url, timeout):
        self.gets.append((url, timeout))
        answer = self.file if url == "f" else self.answers[0] if len(self.answers) == 1 else self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer if isinstance(answer, bytes) else json.dumps(answer).encode()

    def pieces(self, url, timeout):
        whole = self.get(url, timeout)
        yield from (whole[k : k + 7] for k in range(0, len(whole), 7))


def job(script):
    clock = Clock()
    return ExportJob("e", script, clock, clock.sleep), clock


def test_request():
    r = ExportRequest.sample(date(2025, 3, 1))
    assert r.document() == {"filters": {"prime_award_types": list(AWARD_TYPES), "date_type": "action_date", "date_range": {"start_date": "2025-02-27", "end_date": "2025-03-01"}, "agencies": [{"type": "awarding", "tier": "toptier", "name": "All"}]}, "file_format": "csv"}
    assert len(AWARD_TYPES) == 12 and "columns" in ExportRequest.sample(date(2025, 3, 1), columns=["a"]).document()


@pytest.mark.parametrize("submit", [ConnectionError("no"), {}, {"status_url": "s"}, {"status_url": "", "file_url": "f"}, [], {"status_url": "s", "file_url": None}])
def test_failed_submit(submit):
    script = Script(submit=submit)
    content, reason = job(script)[0].fetch(ExportRequest.sample())
    assert content == b"" and reason and len(script.posts) == 1 and not script.gets


@pytest.mark.parametrize(
    ("answers", "ok", "checks"),
    [
        ([{"status": "finished"}], True, 1),
        ([{"status": "running"}, {}, {"status": "FINISHED"}], True, 3),
        ([{"status": "failed"}], False, 1),
        ([{"status": "ready"}, {"status": "Error"}], False, 2),
        ([{"status": None}, {"status": "finished"}], True, 2),
        ([OSError("x"), b"no json", {"status": "finished"}], True, 3),
        ([{"status": "running"}], False, 30),
    ],
)
def test_wait(answers, ok, checks):
    script = Script(*answers)
    own, clock = job(script)
    waited = own.wait("s")
    assert (waited.ok, waited.checks) == (ok, checks) and len(script.gets) == checks
    assert clock.now == 10 * (checks if waited.reason == "timed out" else checks - 1)


def test_guards():
    own, _ = job(Script(file=OSError("gone")))
    assert not own.wait("").ok and own.download(None) == b"" and own.download("f") == b""
    assert job(Script({"status": "error"}))[0].fetch(ExportRequest.sample()) == (b"", "waiting failed: error")
    assert job(Script({"status": "finished"}, file=OSError("x")))[0].fetch(ExportRequest.sample())[1] == "download failed"
    assert job(Script({"status": "finished"}))[0].fetch(ExportRequest.sample()) == (b"PK", None)


def test_narrowed_range():
    day, span = ("action_date",), (date(2025, 9, 22), date(2025, 9, 24))
    assert narrowed([], *span) == span
    assert narrowed([GreaterThanOrEqual(day, "2025-09-23"), LessThanOrEqual(day, "2025-12-31"), LessThanOrEqual(("other",), "2000-01-01"), EqualTo(("award_type",), "A"), GreaterThanOrEqual(day, "soon")], *span) == (date(2025, 9, 23), date(2025, 9, 24))
    assert narrowed([GreaterThan(day, "2025-09-22"), LessThan(day, "2025-09-24")], *span) == (date(2025, 9, 23),) * 2
    assert narrowed([In(day, ("2025-09-24", "2025-09-23"))], *span) == (date(2025, 9, 23), date(2025, 9, 24))
    assert narrowed([EqualTo(day, "2025-09-23")], *span) == (date(2025, 9, 23),) * 2


def test_source(spark, tmp_path):
    ship(spark)
    spark.dataSource.register(BulkExport)
    options = lambda **o: {"endpoint": "x://y", "transport": "colwarden.sources.offline:OfflineTransport", "landing": tmp_path.as_uri(), "as_of": "2025-09-24"} | o
    reader = lambda **o: spark.read.format("bulk_export").options(**options(**o)).load()
    df = reader()
    assert len(df.columns) == 54 and df.count() == 300  # three days of seven
    one = df.where("action_date >= '2025-09-23' AND action_date <= '2025-09-23'")
    assert one.count() == 100 and one.select("transaction_description").distinct().first()[0] == 'line one\nline "two"'
    assert one.union(df).count() == 400 and df.count() == 300
    assert len(list(tmp_path.glob("export-*.zip"))) == len(list(tmp_path.iterdir())) == 1  # one job for all actions of a load
    several = reader(transport_options='{"entries": 3}')
    assert several.rdd.getNumPartitions() == 3 and sorted(several.collect(), key=str) == sorted(df.collect(), key=str)
    assert reader(columns="award_type,absent", award_types="A").distinct().collect() == [("A", None)]
    assert reader(start="2025-09-25", end="2025-09-24").count() == 0
    asked = exported(spark, [EqualTo(("action_date",), "2025-09-23"), In(("award_type",), ("A", "B"))], **options())
    assert asked.count() == 50 and exported(spark, [GreaterThan(("action_date",), "2025-09-24")], **options()).count() == 0
    with pytest.raises(Exception, match="waiting failed: timed out|submit failed"):
        reader(transport_options='{"broken": true}').count()


def test_offline_first_pending():
    transport = OfflineTransport(pending=1)
    own, clock = job(transport)
    content, reason = own.fetch(ExportRequest.sample(date(2025, 9, 21)))
    assert reason is None and content[:2] == b"PK" and clock.now == 10


def test_replay(spark):
    t = lambda m: datetime(2024, 1, 1, 0, m)
    log = spark.createDataFrame([(1, t(1), 1, "running"), (1, t(3), 2, "failed"), (1, t(2), 3, "Finished"), (2, t(1), 4, None), (3, t(9), 5, "error"), (4, t(1), 7, "error"), (4, t(1), 6, "finished")], "job INT, ts TIMESTAMP_NTZ, id INT, status STRING")
    got = {r["job"]: (r["state"], r["ended_at"]) for r in first_ends(log, "job", "ts", "id", "status").collect()}
    assert got == {1: ("finished", t(2)), 2: ("pending", None), 3: ("failed", t(9)), 4: ("finished", t(1))}
    late = within_limit(first_ends(log, "job", "ts", "id", "status"), F.lit(t(0)).cast("timestamp_ntz"), 5)
    assert {r["job"]: r["state"] for r in late.collect()} == {1: "finished", 2: "timed out", 3: "timed out", 4: "finished"}


GOOD = packed([("a.csv", ",".join(CONTRACT_FIELDS).encode() + b"\n")])
FINISHED = {"status": "finished"}


@pytest.mark.parametrize(
    ("script", "status", "reason", "asked"),
    [
        (Script(submit=OSError("no")), 2, "submit failed: no", []),
        (Script({"status": "failed"}), 2, "waiting failed: failed", ["s"]),
        (Script({"status": "running"}), 2, "waiting failed: timed out", ["s"] * 30),
        (Script(FINISHED, file=OSError("cut")), 2, "download failed", ["s", "f"]),
        (Script(FINISHED, file=b""), 2, "download failed", ["s", "f"]),
        (Script(FINISHED, file=b"<html>"), 2, "not a ZIP archive", ["s", "f"]),
        (Script(FINISHED, file=packed([("a.csv", b"\nx\n")])), 2, "no fields were discovered", ["s", "f"]),
        (Script(FINISHED, file=packed([("a.csv", b"award_type,action_date\n")])), 1, None, ["s", "f"]),
        (Script(FINISHED, file=GOOD), 0, None, ["s", "f"]),
    ],
)
def test_run(spark, tmp_path, script, status, reason, asked):
    own, _ = job(script)
    outcome = verify_export(spark, own, ExportRequest.sample(), tmp_path.as_uri())
    assert (outcome.status, outcome.reason) == (status, reason)
    assert [u for u, _ in script.gets] == asked and len(script.posts) == 1  # nothing is repeated, nothing follows a failure
    assert (outcome.summary is None) == (status == 2) and own.log
    if status < 2:
        row = outcome.summary.first()
        assert row["all_available"] == (status == 0) and row["available"] == (54 if status == 0 else 2)


def test_landing_keeps_whole_files_only(tmp_path):
    class Cut(Script):
        def pieces(self, url, timeout):
            yield b"PK12"
            raise OSError("cut")

    with pytest.raises(ExportFailed, match="download failed"):
        land(job(Cut(FINISHED))[0], ExportRequest.sample(), tmp_path.as_uri())
    assert not list(tmp_path.iterdir())
    assert open(land(job(Script(FINISHED, file=GOOD))[0], ExportRequest.sample(), str(tmp_path)), "rb").read() == GOOD


def test_command(spark, tmp_path, capsys):
    assert main(["offline://awards", str(tmp_path), "--transport", "colwarden.sources.offline:OfflineTransport"]) == 0
    assert "available: 54 of 54" in capsys.readouterr().out
