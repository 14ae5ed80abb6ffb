"""Queries of the schema-contract engine, each with its DuckDB equivalent where SQL can express it."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThanOrEqual, In, LessThan

from .functions import scalar
from .operators import compare, json_fields, report, slim, verify
from .operators.account import typed_layer
from .operators.near_miss import near_misses
from .plans.contract import CONTRACT_FIELDS, EARLIER_CONTRACT_FIELDS, ETL_FIELDS, PROBED_FIELD, relation, values_sql
from .sources.archive import archive_headers
from .sources.archive_table import archive_files, entries_of, entry_rows, first_headers, read_pruned, write_archives
from .sources.footers import table_profile, type_problems
from .sources.jobs import ExportJob, ExportRequest
from .sources.slim_sink import load_window, read_slim
from .sources.storage import workspace
from .streaming.landing import first_ends, within_limit
from .streaming.poll_log import poll_ends, run_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: What the contract queries over the events table ask for: one name is missing, one differs in case.
EVENT_CONTRACT = ("event_id", "ts", "user_id", "event_type", "value", "props", "session_id", "TS")
SLIM_LINEITEM = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
HEADERS = (' "action_date" ', "award_id_piid\t", '""naics_code""', "  recipient_uei", 'plain"inside', '" blank inside quotes "', "", '"')
ENTRIES = ("readme.txt", "data/Part_1.CSV", "data/part_2.csv", "csv", "x.csv.bak")
STATUSES = ("finished", "FINISHED", "Failed", "error", "running", "", None)

LISTS = f"""contract(pos, field) AS (VALUES {values_sql(CONTRACT_FIELDS)}),
etl(pos, field) AS (VALUES {values_sql(ETL_FIELDS)}),
earlier(pos, field) AS (VALUES {values_sql(EARLIER_CONTRACT_FIELDS)}),
wanted(pos, field) AS (VALUES {values_sql(EVENT_CONTRACT)}),
found(field) AS (SELECT column_name FROM (DESCRIBE events))"""


REQUEST_SCHEMA = """filters STRUCT<prime_award_types: ARRAY<STRING>, date_type: STRING, date_range: STRUCT<start_date: STRING, end_date: STRING>,
agencies: ARRAY<STRUCT<type: STRING, tier: STRING, name: STRING>>>, file_format STRING"""


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = f"WITH {LISTS} {sql}" if "FROM" in sql and "WITH" not in sql else sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, values: Sequence[str | None]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values)), "i INT, s STRING")


def texts_sql(values: Sequence[str | None]) -> str:
    cell = lambda v: "NULL" if v is None else "'" + v.replace("'", "''").replace("\t", "' || chr(9) || '") + "'"
    return "(VALUES " + ", ".join(f"({i}, {cell(v)})" for i, v in enumerate(values)) + ") v(i, s)"


@query("SELECT pos, field FROM contract")
def contract_fields(spark, sf_dir):
    return relation(spark, CONTRACT_FIELDS)


@query("SELECT pos, field FROM etl")
def etl_list_fields(spark, sf_dir):
    return relation(spark, ETL_FIELDS)


@query("SELECT pos, field FROM earlier")
def earlier_contract_fields(spark, sf_dir):
    return compare.ordered(relation(spark, EARLIER_CONTRACT_FIELDS))


@query("SELECT field FROM contract EXCEPT SELECT field FROM etl")
def contract_minus_repo(spark, sf_dir):
    return compare.only_in(relation(spark, CONTRACT_FIELDS), relation(spark, ETL_FIELDS))


@query("SELECT field FROM etl EXCEPT SELECT field FROM contract")
def repo_minus_contract(spark, sf_dir):
    return compare.only_in(relation(spark, ETL_FIELDS), relation(spark, CONTRACT_FIELDS))


@query("SELECT field FROM contract INTERSECT SELECT field FROM etl")
def contract_and_repo(spark, sf_dir):
    return compare.common(relation(spark, CONTRACT_FIELDS), relation(spark, ETL_FIELDS))


@query(f"SELECT field FROM contract EXCEPT SELECT field FROM found EXCEPT SELECT '{PROBED_FIELD}'")
def chained_difference(spark, sf_dir):
    return compare.only_in(relation(spark, CONTRACT_FIELDS), verify.fields_of(table(spark, sf_dir, "events")), PROBED_FIELD)


@query("""SELECT (SELECT count(*) FROM etl) AS etl_fields, (SELECT count(*) FROM contract) AS contract_fields,
(SELECT count(*) FROM (SELECT field FROM etl INTERSECT SELECT field FROM contract)) AS common_fields,
coalesce((SELECT list(field ORDER BY field) FROM (SELECT field FROM etl EXCEPT SELECT field FROM contract)), []) AS etl_only,
coalesce((SELECT list(field ORDER BY field) FROM (SELECT field FROM contract EXCEPT SELECT field FROM etl) WHERE field <> 'solicitation_identifier'), []) AS contract_only,
(SELECT count(*) FROM (SELECT field FROM contract EXCEPT SELECT field FROM etl) WHERE field <> 'solicitation_identifier') = 0 AS compatible""")
def list_difference(spark, sf_dir):
    return compare.difference(relation(spark, ETL_FIELDS), relation(spark, CONTRACT_FIELDS))


@query("SELECT field FROM contract WHERE lower(field) LIKE '%solicitation%'")
def related_fields(spark, sf_dir):
    return verify.related(relation(spark, CONTRACT_FIELDS), "Solicitation")


@query("SELECT field FROM wanted EXCEPT SELECT field FROM found")
def missing_fields_events(spark, sf_dir):
    return verify.missing(relation(spark, EVENT_CONTRACT), verify.fields_of(table(spark, sf_dir, "events")))


@query("SELECT field FROM wanted INTERSECT SELECT field FROM found")
def available_fields_events(spark, sf_dir):
    return verify.available(relation(spark, EVENT_CONTRACT), verify.fields_of(table(spark, sf_dir, "events")))


@query("""SELECT count(*) AS total_required, count(*) FILTER (WHERE h.field IS NOT NULL) AS available,
list(w.field ORDER BY w.field) FILTER (WHERE h.field IS NULL) AS missing,
count(*) FILTER (WHERE w.field = 'value' AND h.field IS NOT NULL) > 0 AS probe_available,
(SELECT list(field ORDER BY field) FROM found WHERE lower(field) LIKE '%event%') AS related,
count(*) FILTER (WHERE h.field IS NULL) = 0 AS all_available
FROM (SELECT DISTINCT field FROM wanted) w LEFT JOIN (SELECT DISTINCT field FROM found) h ON w.field = h.field""")
def verify_summary_events(spark, sf_dir):
    return verify.summary(relation(spark, EVENT_CONTRACT), verify.fields_of(table(spark, sf_dir, "events")), probe="value", related_to="event")


@query(" UNION ALL ".join(f"SELECT '{t}' AS source, column_name AS field FROM (DESCRIBE {t})" for t in TABLES))
def discovered_fields(spark, sf_dir):
    parts = [verify.fields_of(table(spark, sf_dir, t)).select(F.lit(t).alias("source"), "field") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT max(field = 'event_type') AS present FROM found")
def field_membership(spark, sf_dir):
    return verify.has_field(verify.fields_of(table(spark, sf_dir, "events")), "event_type")


@query("SELECT count(*) AS n_listed, count(DISTINCT field) AS n_distinct FROM (SELECT field FROM contract UNION ALL SELECT field FROM etl)")
def field_count_distinct(spark, sf_dir):
    return verify.counts(relation(spark, CONTRACT_FIELDS + ETL_FIELDS))


@query("SELECT count(*) AS n_fields, string_agg(field, ', ' ORDER BY pos) AS fields FROM etl")
def final_field_list(spark, sf_dir):
    return compare.final_list(relation(spark, ETL_FIELDS))


@query(f"SELECT {', '.join(SLIM_LINEITEM)} FROM lineitem")
def slim_projection(spark, sf_dir):
    return slim.slim(table(spark, sf_dir, "lineitem"), SLIM_LINEITEM)


@query("SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-03'")
def sample_request_filter(spark, sf_dir):
    day = F.col("o_orderdate")
    span = day.between(F.lit("1997-03-01").cast("timestamp_ntz"), F.lit("1997-03-03").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & span)


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.status_url') AS status_url,
coalesce(json_extract_string(props, '$.status'), '') AS status, coalesce(json_extract_string(props, '$.status_url'), '') <> '' AS has_handle FROM events""")
def json_handles(spark, sf_dir):
    doc = F.col("props")
    url = scalar.handle(doc, "status_url")
    return table(spark, sf_dir, "events").select("event_id", scalar.handle(doc, "k").alias("k"), url.alias("status_url"), F.coalesce(scalar.handle(doc, "status"), F.lit("")).alias("status"), scalar.present(url).alias("has_handle"))


@query("""SELECT event_id, CASE WHEN lower(coalesce(event_type, '')) = 'finished' THEN 'finished' WHEN lower(coalesce(event_type, '')) IN ('failed', 'error') THEN 'failed' ELSE 'pending' END AS state FROM events""")
def status_classify(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", scalar.job_state(F.col("event_type")).alias("state"))


@query(f"SELECT i, CASE WHEN lower(coalesce(s, '')) = 'finished' THEN 'finished' WHEN lower(coalesce(s, '')) IN ('failed', 'error') THEN 'failed' ELSE 'pending' END AS state FROM {texts_sql(STATUSES)}")
def status_values(spark, sf_dir):
    return texts(spark, STATUSES).select("i", scalar.job_state(F.col("s")).alias("state"))


_REPLAY = "CASE WHEN event_type = 'purchase' THEN 'finished' WHEN event_type = 'error' THEN 'failed' ELSE 'pending' END"


@query(f"""SELECT user_id, coalesce(arg_min(state, (ts, event_id)) FILTER (WHERE state <> 'pending'), 'pending') AS state,
min(ts) FILTER (WHERE state <> 'pending') AS ended_at FROM (SELECT *, {_REPLAY} AS state FROM events) GROUP BY user_id""")
def poll_first_terminal(spark, sf_dir):
    log = table(spark, sf_dir, "events").withColumn("status", F.when(F.col("event_type") == "purchase", "finished").otherwise(F.col("event_type")))
    return first_ends(log, "user_id", "ts", "event_id", "status")


@query(f"SELECT arg_min(s, i) AS entry FROM {texts_sql(ENTRIES)} WHERE lower(s) LIKE '%.csv'")
def first_csv_entry(spark, sf_dir):
    return texts(spark, ENTRIES).where(scalar.is_csv(F.col("s"))).agg(F.min_by("s", "i").alias("entry"))


@query(f"SELECT i, trim(regexp_replace(s, '^\\s+|\\s+$', '', 'g'), '\"') AS name FROM {texts_sql(HEADERS)}")
def header_normalise(spark, sf_dir):
    return texts(spark, HEADERS).select("i", scalar.clean_name(F.col("s")).alias("name"))


@query(f"""SELECT user_id, CASE WHEN ended_at IS NULL OR ended_at >= TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 2880 MINUTE THEN 'timed out' ELSE state END AS state, ended_at FROM (
SELECT user_id, coalesce(arg_min(state, (ts, event_id)) FILTER (WHERE state <> 'pending'), 'pending') AS state,
min(ts) FILTER (WHERE state <> 'pending') AS ended_at FROM (SELECT *, {_REPLAY} AS state FROM events) GROUP BY user_id)""")
def poll_within_limit(spark, sf_dir):
    return within_limit(poll_first_terminal(spark, sf_dir), F.lit("2024-01-01").cast("timestamp_ntz"), 2880)


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, props->>'$.status' AS status FROM events")
def json_parse(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k BIGINT, status STRING").alias("d")).select("event_id", "d.k", "d.status")


@query("""SELECT to_json({'filters': {'prime_award_types': ['A', 'B', 'C', 'D', 'IDV_A', 'IDV_B', 'IDV_B_A', 'IDV_B_B', 'IDV_B_C', 'IDV_C', 'IDV_D', 'IDV_E'],
'date_type': 'action_date', 'date_range': {'start_date': '2025-09-22', 'end_date': '2025-09-24'},
'agencies': [{'type': 'awarding', 'tier': 'toptier', 'name': 'All'}]}, 'file_format': 'csv'})::VARCHAR AS document""")
def request_document(spark, sf_dir):
    request = ExportRequest.sample(date(2025, 9, 24)).document()
    return spark.createDataFrame([request], REQUEST_SCHEMA).select(F.to_json(F.struct("filters", "file_format")).alias("document"))


@query("SELECT event_id, strftime(ts::DATE - INTERVAL 2 DAY, '%Y-%m-%d') AS start_date, strftime(ts::DATE, '%Y-%m-%d') AS end_date FROM events")
def sample_window(spark, sf_dir):
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select("event_id", scalar.window_start(day).alias("start_date"), scalar.window_end(day).alias("end_date"))


@query("SELECT page_id, coalesce(starts_with(html, '<!'), false) AS is_markup, substr(html, 1, 100) AS head FROM pages")
def head_slice(spark, sf_dir):
    markup = scalar.begins_with(F.col("html").cast("binary"), "3C21")
    return table(spark, sf_dir, "pages").select("page_id", markup.alias("is_markup"), scalar.head(F.col("html")).alias("head"))


@query(f"""SELECT line FROM (SELECT 1 AS k, repeat('=', 70) AS line UNION ALL SELECT 2, 'available: 53 of 54' UNION ALL SELECT 3, 'missing:'
UNION ALL SELECT 4, '  - {PROBED_FIELD}' UNION ALL SELECT 5, 'related:' UNION ALL SELECT 6, '  - ' || field FROM etl WHERE contains(field, 'solicitation')
UNION ALL SELECT 7, 'required fields are missing')""")
def verification_report(spark, sf_dir):
    return report.lines(verify.summary(relation(spark, CONTRACT_FIELDS), relation(spark, ETL_FIELDS)))


def packed(entries: Sequence[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries:
            z.writestr(name, content)
    return out.getvalue()


@query("""SELECT 'good.zip' AS path, 'Data.CSV' AS entry, list(field ORDER BY pos) || ['extra', 'action_date'] AS fields, NULL::VARCHAR AS reason FROM contract
UNION ALL SELECT 'short.zip', 'd.csv', list(field ORDER BY pos DESC), NULL FROM etl
UNION ALL SELECT 'none.zip', NULL, []::VARCHAR[], 'no CSV entry' UNION ALL SELECT 'text.zip', NULL, []::VARCHAR[], 'not a ZIP archive'""")
def archive_headers_query(spark, sf_dir):
    """Headers of archives made on the spot: one complete, one shuffled and short of a field, one without a CSV, one not ZIP."""
    full = ",".join(CONTRACT_FIELDS).encode()
    made = [
        ("good.zip", packed([("readme.txt", b"x"), ("Data.CSV", full + b",extra,action_date\n1,2\n"), ("other.csv", b"a\n")])),
        ("short.zip", packed([("d.csv", ",".join(reversed(ETL_FIELDS)).encode() + b"\r\n")])),
        ("none.zip", packed([("readme.txt", b"x")])),
        ("text.zip", b"not an archive"),
    ]
    archives = spark.createDataFrame([(p, bytearray(c)) for p, c in made], "path STRING, content BINARY")
    return archive_headers(archives)


QUERIES["archive_headers"] = QUERIES.pop("archive_headers_query")
ORACLE_SQL["archive_headers"] = ORACLE_SQL.pop("archive_headers_query")


@query("""SELECT line FROM (SELECT 1 AS k, repeat('=', 70) AS line UNION ALL SELECT 2, 'available: 54 of 54' UNION ALL SELECT 3, 'missing: none'
UNION ALL SELECT 4, 'related:' UNION ALL SELECT 5, '  - ' || field FROM (SELECT field FROM contract UNION SELECT 'solicitation_procedures_code')
WHERE contains(field, 'solicitation') UNION ALL SELECT 6, 'all required fields are available')""")
def export_run(spark, sf_dir):
    """The report of a whole run against the offline transport, from submit to verdict."""
    from .sources.landed import verify_export
    from .sources.offline import OfflineTransport

    job = ExportJob("offline://awards", OfflineTransport())
    return report.lines(verify_export(spark, job, ExportRequest.sample(date(2025, 9, 24)), workspace(spark, "landing")).summary)


def pushdown_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a bulk export by the offline transport, with the date bounds in the request."""
    from .sources.bulk_export import exported

    day = ("action_date",)
    rows = exported(spark, [GreaterThanOrEqual(day, "2025-09-23"), LessThan(day, "2025-09-25")], endpoint="offline://awards", transport="colwarden.sources.offline:OfflineTransport", landing=workspace(spark, "landing"), as_of="2025-09-24", columns="award_id_piid,action_date,award_type,federal_action_obligation")
    return rows.select("award_id_piid", "action_date", "award_type", F.col("federal_action_obligation").try_cast("double").alias("obligation"))


QUERIES["pushdown_source"] = pushdown_source
ORACLE_SQL["pushdown_source"] = """SELECT 'AW' || lpad(i::VARCHAR, 4, '0') AS award_id_piid, strftime(DATE '2025-09-20' + (i % 7)::INT, '%Y-%m-%d') AS action_date,
['A', 'B', 'C', 'D'][(i % 4 + 1)::INT] AS award_type, (i * 10.25)::DOUBLE AS obligation FROM range(700) t(i) WHERE i % 7 BETWEEN 3 AND 4"""


def orders_as_archives(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The orders table, written as archives of many entries by date; and their folder."""
    orders, folder = table(spark, sf_dir, "orders"), workspace(spark, "archives")
    write_archives(orders.repartitionByRange("o_orderdate").sortWithinPartitions("o_orderdate"), folder, zones=("o_orderdate", "o_orderpriority", "o_orderkey"), rows_per_entry=2_000)
    return orders, folder


def retyped(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in like.schema])


@query("SELECT * FROM orders")
def archive_table_rows(spark, sf_dir):
    """orders through archives: directories read by range, tasks planned by entry bytes, entries inflated from their ranges."""
    orders, folder = orders_as_archives(spark, sf_dir)
    return retyped(entry_rows(entries_of(archive_files(spark, folder)), orders.columns), orders)


@query("SELECT row_number() OVER () - 1 AS pos, column_name AS field, true AS all_available FROM (DESCRIBE orders)")
def archive_table_headers(spark, sf_dir):
    """The names that the first entry of every archive has, and whether every archive has all names of the table."""
    orders, folder = orders_as_archives(spark, sf_dir)
    headers = first_headers(entries_of(archive_files(spark, folder)))
    want = F.array(*map(F.lit, orders.columns))
    names = headers.select(F.posexplode("fields").alias("pos", "field"), (F.size(F.array_except(want, "fields")) == 0).alias("all_available"))
    return names.groupBy(F.col("pos").cast("long").alias("pos"), "field").agg(F.every("all_available").alias("all_available"))


@query("SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-06-01'")
def archive_table_pruned(spark, sf_dir):
    """A filter like that of sample_request_filter, applied to the manifest first, so that entries of other dates are never opened."""
    orders, folder = orders_as_archives(spark, sf_dir)
    day = ("o_orderdate",)
    asked = [In(("o_orderpriority",), ("1-URGENT", "2-HIGH")), GreaterThanOrEqual(day, "1997-03-01"), LessThan(day, "1997-06-01")]
    return retyped(read_pruned(spark, folder, orders.columns, asked), orders)


@query(f"""SELECT user_id, CASE WHEN ended_at IS NULL OR ended_at >= TIMESTAMP '2024-01-03 00:00:00' THEN 'timed out' ELSE state END AS state,
CASE WHEN ended_at < TIMESTAMP '2024-01-03 00:00:00' THEN ended_at END AS ended_at FROM (
SELECT user_id, coalesce(arg_min(state, (ts, event_id)) FILTER (WHERE state <> 'pending'), 'pending') AS state,
min(ts) FILTER (WHERE state <> 'pending') AS ended_at FROM (SELECT *, {_REPLAY} AS state FROM events) GROUP BY user_id)""")
def poll_stream(spark, sf_dir):
    """events as a poll log that lands week by week and is followed as a stream, with a stop and a restart from its checkpoint."""
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.when(F.col("event_type") == "purchase", "finished").otherwise(F.col("event_type")).alias("status"))
    landing, out, checkpoint = (workspace(spark, name) for name in ("polls", "ends", "progress"))
    days = ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01")
    week = lambda a, b: log.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
    for k in (0, 2):
        for a, b in zip(days[k : k + 2], days[k + 1 : k + 3], strict=True):
            week(a, b).write.mode("append").parquet(landing)
        polls = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1_000).parquet(landing)
        begun = F.lit("2024-01-01").cast("timestamp_ntz")
        run_available(poll_ends(polls, "user_id", "ts", "event_id", "status", begun, 2880, "8 days"), out, checkpoint)
    return spark.read.schema("user_id LONG, state STRING, ended_at TIMESTAMP_NTZ").parquet(out)


#: Spark's names of DuckDB's types, as SQL.
_TYPE = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"
#: A contract of names and types over the tables; two are wrong and one is missing wherever they are asked.
TYPED_CONTRACT = {"doc_id": "bigint", "text": "string", "value": "int", "ts": "timestamp_ntz", "award_id_piid": "string"}
_NAMES = " UNION ALL ".join(f"SELECT '{t}' AS source, column_name AS field, {_TYPE} AS type FROM (DESCRIBE {t})" for t in TABLES)


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS source, d.field, d.type, (SELECT count(*) FROM {t}) AS n_rows, CASE WHEN d.type NOT LIKE 'array%' THEN u.n_null END AS n_null
FROM (SELECT column_name AS field, {_TYPE} AS type FROM (DESCRIBE {t})) d JOIN (UNPIVOT (SELECT count(*) - count(COLUMNS('(.*)')) AS '\\1' FROM {t}) ON COLUMNS(*) INTO NAME field VALUE n_null) u ON u.field = d.field"""
        for t in TABLES
    )
)
def footer_profile(spark, sf_dir):
    """Types, rows and nulls of every column of every table, from footers alone."""
    return table_profile(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES}).drop("pos")


@query(f"""SELECT t.source, w.field, CASE WHEN h.type IS NULL THEN 'missing' ELSE 'type ' || h.type || ', not ' || w.want END AS problem
FROM (SELECT DISTINCT source FROM ({_NAMES})) t CROSS JOIN (VALUES {", ".join(f"('{f}', '{k}')" for f, k in TYPED_CONTRACT.items())}) w(field, want)
LEFT JOIN ({_NAMES}) h ON h.source = t.source AND h.field = w.field WHERE h.type IS DISTINCT FROM w.want""")
def footer_contract(spark, sf_dir):
    """What each table lacks of a contract of names and types."""
    return type_problems(table_profile(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES}), TYPED_CONTRACT, "source")


@query("""SELECT e.key AS field, CASE json_type(e.value) WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'text'
WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE lower(json_type(e.value)) END AS kind, count(*) AS n FROM events, json_each(props) e GROUP BY ALL
UNION ALL SELECT NULL, 'object', count(*) FROM events WHERE json_type(props) = 'OBJECT' HAVING count(*) > 0""")
def json_fields_events(spark, sf_dir):
    """Keys and kinds in the documents of events, with counts."""
    return json_fields.json_fields(table(spark, sf_dir, "events"), "props")


@query("""SELECT 'k' AS field, 'integer' AS kind, count(*) FILTER (WHERE json_type(props, '$.k') IN ('BIGINT', 'UBIGINT')) AS fitting,
count(*) FILTER (WHERE json_type(props, '$.k') NOT IN ('BIGINT', 'UBIGINT')) AS other_kind, count(*) FILTER (WHERE json_type(props, '$.k') IS NULL) AS absent FROM events
UNION ALL SELECT 'status_url', 'text', count(*) FILTER (WHERE json_type(props, '$.status_url') = 'VARCHAR'),
count(*) FILTER (WHERE json_type(props, '$.status_url') <> 'VARCHAR'), count(*) FILTER (WHERE json_type(props, '$.status_url') IS NULL) FROM events""")
def json_contract_events(spark, sf_dir):
    """Whether the documents of events keep a contract of keys and kinds."""
    return json_fields.json_contract(json_fields_events(spark, sf_dir), {"k": "integer", "status_url": "text"})


@query(f"SELECT {', '.join(SLIM_LINEITEM)} FROM lineitem")
def slim_sink_replay(spark, sf_dir):
    """lineitem through the slim sink: all of it, one year again, and the years from then on again, read back."""
    rows, path = table(spark, sf_dir, "lineitem"), workspace(spark, "slim")
    for start, end in ((None, None), ("1995-01-01", "1996-01-01"), ("1995-01-01", None)):
        load_window(rows, path, "l_shipdate", start, end, SLIM_LINEITEM)
    return read_slim(spark, path)


_RAW_EVENTS = "SELECT event_id, props->>'$.k' AS k, '2024-02-' || lpad(props->>'$.k', 2, '0') AS day, value::VARCHAR AS value FROM events"


@query(f"""WITH raw AS ({_RAW_EVENTS}), cast_ AS (SELECT *, try_cast(k AS DECIMAL(3, 2)) AS k_, try_cast(day AS DATE) AS day_ FROM raw)
SELECT 'k' AS field, 'decimal(3,2)' AS kind, count(*) AS n_rows, count(*) - count(k) AS n_null, count(*) FILTER (WHERE k IS NOT NULL AND k_ IS NULL) AS n_failed FROM cast_
UNION ALL SELECT 'day', 'date', count(*), count(*) - count(day), count(*) FILTER (WHERE day IS NOT NULL AND day_ IS NULL) FROM cast_""")
def typed_account(spark, sf_dir):
    """Failed casts of texts of events, counted while the typed layer is written."""
    return _typed_events(spark, sf_dir).account


@query(f"""WITH raw AS ({_RAW_EVENTS}), cast_ AS (SELECT event_id, k, day, try_cast(k AS DECIMAL(3, 2)) AS k_, try_cast(day AS DATE) AS day_ FROM raw)
SELECT event_id, k, day, list_filter([CASE WHEN k IS NOT NULL AND k_ IS NULL THEN 'k' END, CASE WHEN day IS NOT NULL AND day_ IS NULL THEN 'day' END], lambda x: x IS NOT NULL) AS failed_fields
FROM cast_ WHERE k IS NOT NULL AND k_ IS NULL OR day IS NOT NULL AND day_ IS NULL""")
def typed_rejects(spark, sf_dir):
    """The rows that the same pass kept out of the typed layer, with what failed."""
    return _typed_events(spark, sf_dir).rejected


def _typed_events(spark, sf_dir):
    key = scalar.handle(F.col("props"), "k")
    raw = table(spark, sf_dir, "events").select("event_id", key.alias("k"), F.concat(F.lit("2024-02-"), F.lpad(key, 2, "0")).alias("day"))
    return typed_layer(raw, {"k": "decimal(3,2)", "day": "date"}, workspace(spark, "typed"))


@query(f"""WITH names AS (SELECT DISTINCT field FROM ({_NAMES})) SELECT a.field, b.field AS near, levenshtein(a.field, b.field)::INT AS distance
FROM names a JOIN names b ON a.field <> b.field AND levenshtein(a.field, b.field) <= 2""")
def near_miss_names(spark, sf_dir):
    """For every column name of the tables the other names within two edits."""
    found = discovered_fields(spark, sf_dir)
    return near_misses(found, found)
