"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every text is a blob named by its SHA-256. A ledger holds one row for each (blob, rule, rule version) ever scanned, with
or without findings. A scan hashes all texts, keeps one row per blob, drops those pairs that the ledger has, runs the rules
on what is left, and joins findings back to every row that holds the blob. Ledger keeps the entries as a table in buckets
of blobs, which scans append to: a later scan moves its own digests to the buckets and leaves the ledger where it lies, and
a small one opens no bucket but its own. Text is moved once, keyed by blob and row id, so a blob with a third of all rows
does not meet in one task. The join back carries ids and findings only and may be split by adaptive execution where a blob
is hot.

Defined results: a null text is an empty one, without findings; texts of any length are scanned whole, one at a time; every
input row returns once, repeated rows included; null ids are kept; positions count code points, end exclusive; an empty
table gives an empty result. Extra columns do not take part, but for those named as history (paths, versions of a file),
which go with each row's id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, remove, spill


@dataclass(frozen=True)
class Rule:
    """pattern finds candidates, leftmost and without overlap; those whose group has fewer characters than least are dropped."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0


#: In the order in which kinds are listed where two spans begin at one place.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

LEDGER = "blob string, rule string, version int, spans array<struct<start: int, end: int>>"

#: Up to so many blobs to scan, their texts are found by a broadcast of ids and digests (some 100 bytes each), without
#: moving the others; beyond, by a shuffle.
BROADCAST_BLOBS = 10_000


#: Up to so many blobs in a scan, the ledger is asked for them by name, so that Spark opens their buckets only; beyond, all
#: buckets are read. The driver holds these digests, some 60 KB.
FEW_BLOBS = 500

#: Entries of a bucket that a ledger is laid out for, and bounds of the number of its buckets.
ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 16, 16_384


@dataclass(frozen=True)
class Ledger:
    """A stored ledger: a table in buckets of blobs, in a folder that driver and executors share. Entries that are there twice
    count once. One scan at a time may append.

    The folder has a layout below it for each number of buckets it has had; the newest whole one counts. compact() writes the
    next, with as many buckets as the entries ask for and one file in each.
    """

    path: str
    rows_per_bucket: int = ROWS_PER_BUCKET

    def layouts(self, spark: SparkSession) -> list[tuple[str, int]]:
        """(folder, buckets) of each whole layout, oldest first."""
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(f.getPath().getName() for f in store.listStatus(root)) if store.exists(root) else []
        whole = lambda name: store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS"))
        return [(f"{self.path}/{n}", int(n.rpartition("-")[2])) for n in names if n.startswith("layout-") and whole(n)]

    def table(self, spark: SparkSession, folder: str, buckets: int) -> str:
        """The name under which the session knows a layout. Its catalog is told once; files stay the truth."""
        name = f"spark_catalog.default.colwarden_ledger_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER}) USING parquet CLUSTERED BY (blob) SORTED BY (blob) INTO {buckets} BUCKETS LOCATION '{place}'")
        spark.catalog.refreshTable(name)
        return name

    def read(self, spark: SparkSession) -> DataFrame:
        found = self.layouts(spark)
        return spark.table(self.table(spark, *found[-1])) if found else spark.createDataFrame([], LEDGER)

    def append(self, entries: DataFrame) -> None:
        """Add entries, as scan() gives them. Nothing that is there is written again; a failed append leaves no entry."""
        found = self.layouts(entries.sparkSession)
        folder, buckets = found[-1] if found else self.next_layout(0, entries.count())
        self.write(entries, folder, buckets)

    def compact(self, spark: SparkSession) -> None:
        """Write the next layout, of entries once each, and remove those before; with no scan under way."""
        if not (found := self.layouts(spark)):
            return
        whole = self.read(spark).dropDuplicates(["blob", "rule", "version"])
        number = int(found[-1][0].rpartition("layout-")[2].partition("-")[0])
        self.write(whole, *self.next_layout(number + 1, whole.count()))
        for folder, buckets in found:
            spark.sql(f"DROP TABLE IF EXISTS {self.table(spark, folder, buckets)}")
            remove(spark, folder)

    def next_layout(self, number: int, entries: int) -> tuple[str, int]:
        asked = 1 << max(0, -(-entries // self.rows_per_bucket) - 1).bit_length()
        buckets = min(max(asked, LEAST_BUCKETS), MOST_BUCKETS)
        return f"{self.path}/layout-{number:06}-{buckets}", buckets

    def write(self, entries: DataFrame, folder: str, buckets: int) -> None:
        name = self.table(entries.sparkSession, folder, buckets)
        # a task for each bucket, so that an append adds one file to a bucket at most
        placed = entries.select("blob", "rule", "version", "spans").repartition(buckets, "blob").sortWithinPartitions("blob")
        placed.write.insertInto(name)


def scan_into(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", history: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """scan() against a stored ledger, to which what was scanned now is added. (keys, entries)"""
    known = ledger.read(docs.sparkSession)
    keys, new, old = _scan(docs, known, rules, id_col, text_col, history)
    if not new.isEmpty():
        ledger.append(new)
    return keys, new.unionByName(old)


def find(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the rule's spans in text.

    Splitting by the pattern gives what stands between the matches; with the matches' own lengths, running sums give
    every position in one pass, in code points.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    size = F.transform(whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    hits = F.arrays_zip(gaps.alias("gap"), F.transform(whole, F.char_length).alias("len"), size.alias("size"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["len"], F.lit(0))
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["size"] >= F.lit(max(rule.least, 1)), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.regexp_like(text, pattern), F.aggregate(hits, start, step, lambda acc: acc["spans"])).otherwise(none)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", history: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(keys, entries): keys has (id, blob) and the columns of history for every row; entries is the ledger's part for these blobs and rules, old and new.

    Keep entries, with keys if paths matter, and give them as ledger next time: only blobs or rule versions that it lacks
    are scanned then.
    """
    keys, new, old = _scan(docs, ledger, rules, id_col, text_col, history)
    return keys, new if old is None else new.unionByName(old)


def _scan(docs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...], id_col: str, text_col: str, history: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(keys, new entries, the ledger's entries for these blobs)."""
    if {h.lower() for h in history} & {"id", "blob", "body", "spans"}:
        raise ValueError("history columns must not be called id, blob, body or spans")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"), *[F.col(f"`{h}`") for h in history])
    keys = spill(rows.select("id", blob_of(F.col("body")).alias("blob"), *[F.col(f"`{h}`") for h in history]), "blobs")
    rows = rows.select("id", "body")
    firsts = keys.groupBy("blob").agg(F.min("id").alias("id"))
    wanted = firsts
    known = None
    if ledger is not None:
        known = ledger.select("blob", "rule", "version", "spans")
        few = firsts.select("blob").limit(FEW_BLOBS + 1).collect()
        if len(few) <= FEW_BLOBS:
            known = known.where(F.col("blob").isin([r["blob"] for r in few]))
        now = None
        for r in rules:
            one = (F.col("rule") == r.kind) & (F.col("version") == r.version)
            now = one if now is None else now | one
        known = known.where(now).dropDuplicates(["blob", "rule", "version"])
        done = known.groupBy("blob").agg(F.array_sort(F.collect_set("rule")).alias("done"))
        wanted = firsts.join(done, "blob", "left").where(F.coalesce(F.size("done"), F.lit(0)) < len(rules))
    seen = F.col("done") if ledger is not None else F.lit(None).cast("array<string>")
    wanted = spill(wanted.select(F.col("id").alias("first"), F.col("blob").alias("wanted"), seen.alias("done")), "unseen")
    if wanted.count() <= BROADCAST_BLOBS:
        wanted = F.broadcast(wanted)
    bodies = rows.withColumn("blob", blob_of(F.col("body"))).join(wanted, F.col("id").eqNullSafe(F.col("first")) & (F.col("blob") == F.col("wanted")))
    found = [F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), find(F.col("body"), r).alias("spans")) for r in rules]
    if ledger is not None:
        found = [F.when(~F.coalesce(F.array_contains("done", r.kind), F.lit(False)), x) for r, x in zip(rules, found, strict=True)]
    fresh_rows = bodies.select("blob", F.array_compact(F.array(*found)).alias("found"))
    # repeated rows of one id and text scan alike: one entry is kept
    new = spill(fresh_rows.dropDuplicates(["blob"]).select("blob", F.inline("found")), "ledger")
    return keys, new, None if known is None else known.join(firsts.select("blob"), "blob", "left_semi")


def findings(keys: DataFrame, entries: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, blob, history, spans) for every row of keys: spans array<struct<start, rank, end, kind>>, by start, then rank of the rule."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    each = entries.where(F.size("spans") > 0).select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank[F.col("rule")].alias("rank"), s["end"].alias("end"), F.col("rule").alias("kind"))).alias("spans"))
    # written before it is joined: a join of two plain shuffles may be split at a hot blob
    per_blob = spill(each.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "found")
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return keys.join(per_blob, "blob", "left").select(*[F.col(f"`{c}`") for c in keys.columns], F.coalesce("spans", empty).alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs, every row and column, with each secret in the text replaced by mask. Found through the ledger as by scan().

    Spans of several rules may overlap; overlapping ones are merged and masked as one. Texts without findings, and null
    ones, stay as they are.
    """
    keys, entries = scan(docs, None, rules, id_col, text_col)
    hits = findings(keys, entries, rules).where(F.size("spans") > 0).dropDuplicates(["id", "blob"])
    blob, first, hit, spans = fresh(docs, "blob", "first", "hit", "spans")
    hits = hits.select(F.col("id").alias(first), F.col("blob").alias(hit), F.col("spans").alias(spans))
    # by id and blob, so that copies of one text are dealt over all tasks
    joined = docs.withColumn(blob, blob_of(F.col(text_col))).join(hits, F.col(id_col).eqNullSafe(F.col(first)) & (F.col(blob) == F.col(hit)), "left")
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        inside = s["start"] < acc["at"]
        more = F.when(inside, acc["parts"]).otherwise(F.concat(acc["parts"], F.array(gap, F.lit(mask))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("parts"))

    done = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))
    return joined.withColumn(text_col, F.when(F.size(spans) > 0, done).otherwise(text)).select(*[F.col(f"`{c}`") for c in docs.columns])
