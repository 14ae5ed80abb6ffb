from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from colwarden.llm import url_rules as ur
from colwarden.llm.queries import op2_url_rules


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for mark in "?#":
            rest = rest.split(mark, 1)[0]
        host = rest.split("/", 1)[0]
        path = rest[len(host) :]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, h, p in rules:
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, verdict))
    return host, path, best[2] if best else None, best[3] if best else default


ODD = [None, "", "no scheme", "http://", "http://NET", "http://net/", "https://a.Example.NET/en/x?y#z", "https://example.net/en", "https://example.net:80/en/", "x://u@example.com/de/1", "https://notexample.com/de/", "http://a.org/fr/", "http://a.org/fr", "http://.net/", "http://a..net/b", "https://x.org?u=http://a.net/", "https://x.org#/fr/", "http://İ.net/é", "a://b://c.net/d"]


def check(spark, urls, rules, **options):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = sorted(tuple(r) for r in ur.judge(df, ur.rule_table(spark, rules) if rules else spark.createDataFrame([], "verdict string, host string, path string"), **options).collect())
    assert got == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_odd_urls(spark):
    check(spark, ODD * 3, list(ur.RULES))
    check(spark, ODD, [])
    check(spark, [], list(ur.RULES))


def test_many_parts_and_very_long_urls(spark):
    long = ["https://" + "a." * 3_000 + "example.net/en/" + "x" * 200_000, "https://example.com/de/" + "é" * 100_000, "https://" + "b" * 100_000]
    check(spark, ODD * 3 + long, [*ur.RULES, ("allow", "a.a.example.net", "/"), ("block", "a.example.net", "/en/x")], rows_per_part=2)


def test_equal_rows_spread_and_return(spark):
    row = ("net.a.", False, None, "a.net", "/", None)
    schema = "key string, is_rule boolean, id long, host string, path string, verdict string"
    dealt = ur.deal(spark.createDataFrame([row] * 2_000, schema).repartition(4), spark.createDataFrame([], schema), 5)
    per = [r["count"] for r in dealt.groupBy("part").count().collect()]
    assert sum(per) == 2_000 and max(per) < 1_000
    pages = spark.createDataFrame([(None, "http://a.net/")] * 500, "page_id long, url string").repartition(4)
    got = ur.judge(pages, ur.rule_table(spark, ur.RULES), rows_per_part=50).collect()
    assert len(got) == 500 and {tuple(r) for r in got} == {(None, "a.net", "/", "net/", "block")}


def test_ids_are_kept_exactly(spark):
    ids = [2**62 + 1, 2**53 + 1, -5, None, 7, 7]
    df = spark.createDataFrame([(i, "http://a.net/x") for i in ids], "page_id long, url string")
    got = ur.judge(df, ur.rule_table(spark, ur.RULES)).collect()
    assert sorted(map(str, (r["page_id"] for r in got))) == sorted(map(str, ids)) and {r["rule"] for r in got} == {"net/"}


def test_nested_rules_and_hot_host(spark):
    rules = [("block", "net", ""), ("allow", "b.net", "/x/"), ("block", "a.b.net", "/x/y"), ("allow", "a.b.net", "/"), ("block", "a.b.net", "/"), ("allow", "z", "/")]
    urls = [f"http://{h}/{p}" for h in ("net", "b.net", "a.b.net", "c.a.b.net", "ab.net", "z", "y.z", "y") for p in ("", "x/", "x/y", "x/yy/1", "q")] * 7 + ["http://c.a.b.net/x/y"] * 400
    check(spark, urls, rules)


label = st.sampled_from(["a", "b", "net", "org", ""])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["block", "allow"]), st.lists(label.filter(bool), min_size=1, max_size=3).map(".".join), st.sampled_from(["", "/", "/a", "/a/"])), max_size=8), st.lists(st.tuples(st.lists(label, max_size=4).map(".".join), st.sampled_from(["", "/", "/a", "/a/b", "/b"])), max_size=40))
def test_any(spark, rules, urls):
    check(spark, [f"s://{h}{p}" for h, p in urls], rules)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    got = sorted(tuple(r)[:5] for r in op2_url_rules(spark, sf).collect())
    assert got == sorted((r["page_id"], *brute(r["url"], ur.RULES)) for r in pages)
