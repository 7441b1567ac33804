"""URL filter: parts, rules, tree, branches and purity."""

import pytest
from pyspark.sql import functions as F

from feedgate.llm import url_filter
from feedgate.llm.queries import URL_RULES


@pytest.mark.parametrize(
    "url,host,path",
    [
        ("http://A.Example.ORG/x/Y?q#f", "a.example.org", "/x/Y"),
        ("https://a.org", "a.org", ""), ("https://a.org?x=://b.com/", "a.org", ""), ("x://y://z/", "y:", "//z/"),
        ("no scheme/path", "", ""), ("", "", ""), (None, "", ""), ("ht\ntp://\u00c4.org:80/\n1", "\u00c4.org:80", "/\n1"),
    ],
)
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(*url_filter.host_and_path(F.col("url"))).first()
    assert tuple(row) == (host, path)


@pytest.mark.parametrize(
    "host,path,rule",
    [
        ("example.org", "/en/12", "example.org/en/1"), ("m.example.org", "/es/", "example.org/es/"),
        ("myexample.org", "/es/1", "org/"), ("example.org", "/en/2", "org/"), ("x.com", "/de/1", "com/de/"),
        ("x.com", "/en/1", None), ("org", "", None), ("", "", None), ("x.net", "/fr/", None),
    ],
)
def test_rules(spark, host, path, rule):
    frame = spark.createDataFrame([(host, path)], "host string, path string")
    row = frame.select(url_filter.matched_rule(F.col("host"), F.col("path"), URL_RULES).alias("m")).first()
    assert (row.m and row.m.rule) == rule


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, verdict string")


def test_variable_segments_become_wildcards(spark):
    urls = [f"http://h.net/user/{c * 5}{d}/posts/{i}" for i, (c, d) in enumerate((c, d) for c in "abcdefghij" for d in "xyzuv")]
    urls += ["http://h.net/about", "http://h.net/" + "0a" * 10 + "/x"]
    rows = url_filter.judge_urls(pages_of(spark, urls), URL_RULES).collect()
    assert {r.template for r in rows} == {"/user/*/posts/{n}", "/about", "/{hex}/x"}
    assert all(r.verdict == "allow" or r.verdict == "block" for r in rows)


def test_purity_rejects_and_merges(spark):
    rules = [("block", "bad.net", "/ads/a"), ("allow", "bad.net", "/news/1")]
    urls = [f"http://bad.net/ads/{c}{i}" for c in "ab" for i in range(30)]
    urls += [f"http://bad.net/news/{i}" for i in range(40)] + ["http://other.net/x"]
    rows = url_filter.judge_urls(pages_of(spark, urls), rules).collect()
    told = {r.url: r for r in rows}
    assert told["http://bad.net/ads/a3"].rule == "bad.net/ads/a" and told["http://bad.net/ads/a3"].verdict == "block"
    assert told["http://bad.net/ads/b3"].rule is None and told["http://bad.net/ads/b3"].verdict == "block"
    assert told["http://bad.net/news/25"].verdict == "allow"
    assert told["http://other.net/x"].purity == pytest.approx(30 / 41)


def test_awkward_urls(spark):
    urls = [None, "", "x", None, "http://a.org/", "http://a.org/", "http://a.org/" + "s/" * 50, "http://a.org/" + "q" * 50_000]
    frame = pages_of(spark, urls)
    out = url_filter.judge_urls(frame, URL_RULES)
    rows = out.collect()
    assert len(rows) == len(urls) and out.columns.count("verdict") == 1
    assert all(r.verdict in ("allow", "block") and r.template is not None for r in rows)
    assert url_filter.judge_urls(frame.filter("page_id > 99"), URL_RULES).count() == 0
    unruled = url_filter.judge_urls(frame, []).collect()
    assert {r.purity for r in unruled} == {0.5} and {r.verdict for r in unruled} == {"block"}


def test_branches_at_any_depth(spark):
    slugs = [a + b for a in "abcdefgh" for b in "vwxyz"]
    rules = [(v, "h.net", f"/a/b/c/{s}/{t}") for s in slugs[:12] for v, t in (("block", "ads"), ("allow", "news"))]
    urls = [f"http://h.net/a/b/c/{s}/{t}" for s in slugs for t in ("ads", "news")]
    deep = "/".join(["d"] * 5) + "/{}/e/f"
    urls += ["http://g.net/" + deep.format(s) for s in slugs] + ["http://g.net/" + "/".join("xyxyxyxy"), "http://g.net/p/q/r/s//"]
    told = {r.url: r for r in url_filter.judge_urls(pages_of(spark, urls), rules).collect()}
    for s in slugs:
        ads, news = (told[f"http://h.net/a/b/c/{s}/{t}"] for t in ("ads", "news"))
        assert (ads.template, news.template) == ("/a/b/c/*/ads", "/a/b/c/*/news")
        assert (ads.verdict, news.verdict) == ("block", "allow")
        assert told["http://g.net/" + deep.format(s)].template == "/" + deep.format("*")
    assert told["http://g.net/x/y/x/y/x/y/x/y"].template == "/x/y/x/y/x/y/x/y"
    assert told["http://g.net/p/q/r/s//"].template == "/p/q/r/s//"
