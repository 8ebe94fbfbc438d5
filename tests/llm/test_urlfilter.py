"""Rules on hosts and paths against trying each rule."""

import itertools

import pytest
from edge import CLASHES

from cohortry.llm import queries, urlfilter
from cohortry.llm.urlfilter import Rule

RULES = [
    *queries.URL_RULES,
    Rule("block", "net", ""),
    Rule("allow", "a.net", "/x"),
    Rule("block", "a.net", "/x"),
    Rule("block", "xn--caf-dma.com", "/é/"),
    Rule("block", "", "/"),
]
HOSTS = ["org", "ORG", "example.org", "www.Example.ORG", "notorg", "a.b.c.d.org", "com", "x.com", "net", "b.a.net", "org.", ".org", "", "u@org", "org:80", "É.org"]
PATHS = ["", "/", "/es/", "/es", "/en/1", "/en/12/3", "/fr/a?b=/de/", "/de/x#y", "/x", "?q=/es/", "#/es/", "/é/", "//es/"]
URLS = [f"{s}{h}{p}" for s, h, p in itertools.product(["http://", "x://y://"], HOSTS, PATHS)]
URLS += [None, "", "no scheme", "org/es/", "http:/org/", "://", "http://example.org/es/", "http://example.org/es/"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [
        (len(r.host + r.path), len(r.host), r.verdict, r.host + r.path)
        for r in RULES
        if r.host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


@pytest.mark.parametrize("digits", [1, 8])
def test_all_urls(spark, monkeypatch, digits):
    monkeypatch.setattr(urlfilter, "PREFIX_DIGITS", digits)  # 1: many false meetings for the digests to reject
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "n int, url string")
    rows = urlfilter.judge(urls, urlfilter.rule_table(spark, RULES)).collect()
    assert len(rows) == len(URLS)
    found = {r["n"]: (r["url_host"], r["url_path"], r["url_rule"], r["url_verdict"]) for r in rows}
    assert found == {i: plain(u) for i, u in enumerate(URLS)}


def test_columns_of_the_caller_stay(spark):
    urls = spark.createDataFrame([("http://example.org/es/",)], "url string")
    urls = urls.selectExpr("*", *(f"'clash' as `{c}`" for c in CLASHES))
    row = urlfilter.judge(urls, urlfilter.rule_table(spark, RULES), default="block").first()
    assert all(row[c] == "clash" for c in CLASHES) and row["url_rule"] == "example.org/es/"


def test_no_rules_and_no_urls(spark):
    none = urlfilter.rule_table(spark, [])
    urls = spark.createDataFrame([("http://org/",), (None,)], "url string")
    assert [r["url_verdict"] for r in urlfilter.judge(urls, none, default="block").collect()] == ["block"] * 2
    assert urlfilter.judge(urls.limit(0), urlfilter.rule_table(spark, RULES)).collect() == []
