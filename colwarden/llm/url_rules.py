"""URL filters by a sort-merge range join over reversed-host keys.

A canonical key is the host's labels in reverse, each ended by a dot: sub.example.net gives ``net.example.sub.``. A rule
for a host fits that host and all subdomains, so its key is a prefix of theirs, and the rule is the interval of keys that
begin with it. Intervals of prefixes nest or are apart. Urls and rules are range-partitioned and sorted together by key;
one sweep per partition keeps a stack of the rules whose interval is open. Each entry of the stack holds the paths of one
host's rules by length, and a url asks the stack from all open hosts for its longest path prefixes.

Partitions are cut by (key, path, id, a running number), so a host with a third of all rows spreads over many of them, and
so do equal rows. There are as many as rows_per_part asks for, the session's shuffle setting at least. A rule that opens in
one partition may be open in later ones; the first key of each partition names its open ancestors, so those rules are joined
to that partition and put on the stack before its sweep. Nothing is broadcast or collected, and the rule set may be as
large as the urls. The urls move twice: to be cut, and by the number of their partition to the rules that wait for them.

Defined results: a url that is null or has no ``://`` has an empty host and path, which no rule fits; ports and user names
are part of the host as written; the longest rule (host and path together) wins, then the longer host, then block over
allow; rows without a fitting rule get the default verdict; every input row returns once, repeated rows and null ids included; very
long urls are read whole; extra columns of pages and rules, whatever their names, don't take part; an empty table or an
empty rule set works.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from .common import small, spill

#: (verdict, host, path) of the production rule set.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to a slash, ``?``, ``#`` or the end, A-Z lower-cased. Path: then up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(F.regexp_extract(rest, r"(?s)^[^?#]*", 0), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.substring(rest, F.char_length(host) + 1, F.char_length(rest))


def key_of(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _sweep(rows: Iterator[tuple], default: str) -> Iterator[tuple]:
    """rows: (key, is_rule, id, host, path, verdict), sorted with rules first among equal keys."""
    stack: list[tuple[str, str, dict[str, str], list[int]]] = []  # key, host, verdict by path, path lengths in descending order

    def open_rule(key: str, host: str, path: str, verdict: str) -> None:
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if not stack or stack[-1][0] != key:
            stack.append((key, host, {}, []))
        _, _, verdicts, lengths = stack[-1]
        if verdicts.get(path) != "block":
            verdicts[path] = verdict
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    for key, is_rule, ident, host, path, verdict in rows:
        if is_rule:
            open_rule(key, host, path, verdict)
            continue
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        best: tuple = (-1, -1, "", "")
        for _, rule_host, verdicts, lengths in stack:
            for n in lengths:
                if n + len(rule_host) < best[0]:
                    break
                if n <= len(path) and (found := verdicts.get(path[:n])) is not None:
                    best = max(best, (n + len(rule_host), len(rule_host), rule_host + path[:n], found))
                    break
        yield (ident, host, path, best[2] or None, best[3] or default)


def deal(urls: DataFrame, rules: DataFrame, parts: int) -> DataFrame:
    """Urls and rules together, with the number of the range that each falls in as part."""
    # a rule sorts before the urls of its own key: its path is compared as empty
    rank = F.when(F.col("is_rule"), F.lit("")).otherwise(F.col("path"))
    rows = urls.unionByName(rules).withColumn("rank", rank).withColumn("nth", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(parts, "key", F.desc("is_rule"), "rank", "id", "nth").drop("rank", "nth")
    return spill(dealt.withColumn("part", F.spark_partition_id()), "dealt")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", rows_per_part: int = 1_000_000) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages. rules: (verdict, host, path). Counts pages once."""
    ship(pages.sparkSession)
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    urls = urls.select(key_of(F.col("host")).alias("key"), F.lit(False).alias("is_rule"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    clean = rules.where("host IS NOT NULL AND host <> ''").select(key_of(F.col("host")).alias("key"), F.lit(True).alias("is_rule"), F.lit(None).cast("long").alias("id"), "host", F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct()
    parts = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pages.count() // rows_per_part))
    dealt = deal(urls, clean, parts)
    # the ancestors of each partition's first key are the intervals that may be open where it begins
    firsts = dealt.groupBy("part").agg(F.min("key").alias("first"))
    dots = F.filter(F.sequence(F.lit(1), F.char_length("first")), lambda i: F.substring("first", i, 1) == ".")
    above = F.transform(dots, lambda i: F.substring(F.col("first"), F.lit(1), i))
    ancestors = firsts.where("first <> ''").select("part", F.explode(above).alias("key"))
    carried = dealt.where("is_rule").drop("part").join(ancestors, "key").select(*dealt.columns)
    # rules sort before what they cover, carried ones before all else of the partition
    swept = dealt.unionByName(carried).repartitionById(parts, "part").sortWithinPartitions("part", "key", F.desc("is_rule"))

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), *((c, pa.string()) for c in ("host", "path", "rule", "verdict"))])
        pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        rows = (r for batch in small(batches, 4_096) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[-1]):
            for made in _sweep((r[:-1] for r in group), default):
                out.append(made)
                if len(out) >= 4_096:
                    yield pack(out)
                    out = []
        if out:
            yield pack(out)

    return swept.mapInArrow(work, "page_id long, host string, path string, rule string, verdict string")
