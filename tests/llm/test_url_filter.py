from __future__ import annotations

import random
import re

from tallybayes.llm import url_filter
from tallybayes.llm.queries import URL_RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group().translate(LOWER)
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def judge(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    out = url_filter.verdicts(pages, url_filter.rule_table(spark, rules)).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}


def test_edge_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http:///x", "http://COM/", "https://Example.com/en/a?b#c",
        "http://a.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/es",
        "ftp://x.net?/es/", "http://x.net#a://b/", "http://ÀB.net/fr/é", "a://b://c.net/fr/",
        "http://" + "a." * 3000 + "net/" + "es/" * 3000, "http://.net/fr/", "http://net./fr/",
    ]
    got = judge(spark, urls, URL_RULES)
    for i, u in enumerate(urls):
        assert got[i] == expected(u, URL_RULES), u


def test_rules_whose_path_ends_anywhere_and_ties(spark):
    rules = [
        ("a.com", "/x/y", "block"), ("a.com", "/x/yz", "allow"), ("b.a.com", "/x", "allow"), ("a.com", "", "allow"),
        ("dup.org", "/", "allow"), ("dup.org", "/", "block"), ("org", "/long/", "allow"),
    ]
    rng = random.Random(3)
    urls = [
        "http://" + rng.choice(["a.com", "b.a.com", "c.b.a.com", "dup.org", "x.dup.org", "org", "q.org"])
        + "".join(rng.choice(["/x", "/y", "/yz", "/long", "/", "z", "?q"]) for _ in range(rng.randrange(5)))
        for _ in range(150)
    ]
    got = judge(spark, urls, rules)
    for i, u in enumerate(urls):
        h, p, rule, verdict = expected(u, rules)
        if rule == "dup.org/":
            verdict = "block"  # of equal rules, block
        assert got[i] == (h, p, rule, verdict), u


def test_clashing_columns_repeated_rows_and_empty_tables(spark):
    pages = spark.createDataFrame(
        [(1, "http://x.net/es/", "old", "r"), (1, "http://x.net/es/", "old", "r"), (None, None, None, None)],
        "page_id int, url string, host string, url_host string",
    )
    rules = url_filter.rule_table(spark, URL_RULES)
    rows = url_filter.verdicts(pages, rules).collect()
    assert sorted((str(r["page_id"]), r["url_host"], r["host"], r["verdict"]) for r in rows) == sorted(
        [("1", "r", "x.net", "block")] * 2 + [("None", None, "", "allow")], key=str
    )
    assert url_filter.verdicts(pages.limit(0), rules).count() == 0
    none = url_filter.verdicts(pages, url_filter.rule_table(spark, []), default="block").collect()
    assert [(r["rule"], r["verdict"]) for r in none] == [(None, "block")] * 3


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://x.net/es/")], "page_id int, url string")
    spark.createDataFrame(pages.collect(), pages.schema).createOrReplaceTempView("pages_for_plan")
    df = url_filter.verdicts(spark.sql("select * from pages_for_plan"), url_filter.rule_table(spark, URL_RULES))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_clashing_and_dotted_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/", 5, 6, 7), (2, None, 5, 6, 7)], "page_id int, url string, __rule int, url_rule int, x int")
    pages = pages.withColumnRenamed("x", "a.b").withColumnRenamed("url_rule", "Url_Rule")
    out = url_filter.verdicts(pages, url_filter.rule_table(spark, URL_RULES))
    assert out.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    got = {r["page_id"]: (r["__rule"], r["Url_Rule"], r["a.b"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {1: (5, 6, 7, "net/es/", "block"), 2: (5, 6, 7, None, "allow")}
