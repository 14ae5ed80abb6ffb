"""The thin queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe_codec, fill_in_middle, langid, lexical, mixing, neardup, quality_bands, secret_ledger, sp_codec, toxicity, url_rules, warc
from .common import read, workspace


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken, _ = mixing.repetitions(docs)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES))


OP2_SQL = r"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^?#]*') AS rest FROM a),
c AS (SELECT page_id, regexp_extract(rest, '^[^/]*') AS raw, rest FROM b),
d AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(raw) + 1) AS path FROM c),
r(verdict, rule_host, rule_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT d.*, r.verdict, rule_host || rule_path AS rule FROM d LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS best FROM m)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM n WHERE best = 1
"""


def op3_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.judge(read(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups_of(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x AS doc_id, x AS other FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(md5(text), 'null') AS own, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS pos, source_size * 2.0::DOUBLE AS bound FROM s),
w AS (SELECT *, CASE (pos - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM r),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER b, 0.0::DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS level
      FROM w WINDOW b AS (ORDER BY bound / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, (bound / weight, pos)) AS level FROM l WHERE bound >= level * weight),
t AS (SELECT source, source_size, least(bound, coalesce(f.level * weight, bound)) AS target FROM l, f),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
      ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.own), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM n
"""


def op9_secret_ledger(spark: SparkSession, sf_dir: str, ledger_path: str | None = None) -> DataFrame:
    """A base scan into a stored ledger, then an incremental one, which finds every blob there; rows are of the second."""
    docs, ledger = read(spark, sf_dir, "documents"), secret_ledger.Ledger(ledger_path or workspace(spark, "ledger"))
    secret_ledger.scan_into(docs, ledger)
    keys, entries = secret_ledger.scan_into(docs, ledger)
    found = secret_ledger.findings(keys, entries)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = secret_ledger.digest(F.col("spans"))
    return found.select(F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def op6_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op7_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


OP7_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((strpos('0123456789abcdef', substr(hex, (5 * i // 4)::INT + 1, 1)) - 1) * 16
        + strpos('0123456789abcdef', substr(hex, (5 * i // 4)::INT + 2, 1)) - 1) >> (3 - (5 * i) % 4)::INT) % 32 + 1, 1)), '') AS payload_digest FROM h),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to FROM m
"""


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sp_codec.encode(docs, model_path or default_model())
    csv = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(csv.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op11_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.encode(docs, ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    csv = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(csv.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
a AS (SELECT count(*)::BIGINT AS docs, sum(len(ts))::BIGINT AS terms FROM d WHERE len(ts) > 0),
u AS (SELECT k, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d),
p AS (SELECT k, doc_id, n, term, count(*)::BIGINT AS tf FROM u GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * a.docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term, a.docs),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*)::BIGINT AS often FROM i GROUP BY ALL),
s AS (SELECT item_id, k, doc_id, sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * a.docs) // a.terms))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN p USING (term), a GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fill_in_middle.restore(F.col("output"), F.col("form"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(again).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
s AS (SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
           WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, array_to_string(list_filter(u, lambda v, i: i <= least(x, y)), '') AS p, array_to_string(list_filter(u, lambda v, i: i > least(x, y) AND i <= greatest(x, y)), '') AS m,
      array_to_string(list_filter(u, lambda v, i: i > greatest(x, y)), '') AS z FROM s)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM c
"""


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _op9_sql() -> str:
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    words = "|".join(map(either, ("password", "passwd", "secret", "token"))) + f"|{either('api')}_?{either('key')}"
    # a dollar-quoted text keeps both quotes of the pattern as they are
    assign = rf"$$({words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$$"
    parts = []
    for rank, (kind, pattern, group, least) in enumerate((("assign", assign, 2, 6), ("access", "'AKIA[A-Z0-9]+'", 0, 20), ("hex", "'[0-9a-f]+'", 0, 24))):
        lengths = lambda x: f"list_transform({x}, lambda v: length(v))"
        parts.append(f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, {lengths(f'string_split_regex(t, {pattern})')} AS gap, {lengths(f'regexp_extract_all(t, {pattern})')} AS whole, {lengths(f'regexp_extract_all(t, {pattern}, {group})')} AS size FROM d")
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), k AS ({' UNION ALL '.join(parts)}),
e AS (SELECT doc_id, rank, kind, gap, whole, unnest(list_filter(range(1, len(size) + 1), lambda i: size[i] >= least)) AS i FROM k),
s AS (SELECT doc_id, rank, kind, (list_sum(gap[1:i]) + coalesce(list_sum(whole[1:i - 1]), 0))::BIGINT AS pos, whole[i] AS len FROM e),
a AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
      string_agg(kind || ':' || pos || ':' || (pos + len), ',' ORDER BY pos, rank) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.doc_id = a.doc_id"""


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_url_rules, op3_quality_bands, op4_near_dedup, op5_source_mixing, op6_ann_search, op7_warc_normaliser, op8_sentencepiece, op9_secret_ledger, op10_language_id, op11_byte_bpe, op12_lexical_search, op13_fill_in_middle)}
ORACLE_SQL = {"op4_near_dedup": OP4_SQL, "op2_url_rules": OP2_SQL, "op5_source_mixing": OP5_SQL, "op7_warc_normaliser": OP7_SQL, "op9_secret_ledger": _op9_sql(), "op12_lexical_search": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
