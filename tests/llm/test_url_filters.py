"""URL filters (1): hosts, paths and rules against plain Python; the learned verdicts by held-out accuracy."""

import re

import pytest
from pyspark.sql import functions as F

from surveyspark.llm import url_filters
from surveyspark.llm.catalog import op1_url_filters

SF = "/root/testdata/sf0.01"
EDGE = [None, "", "no scheme", "http://", "http://A.NET", "HTTP://Example.NET/en/x", "x://example.net/en/a?b#c", "https://sub.example.com/de/1", "https://example.com/fr", "http://www.org/fr/?x",
        "http://notnet/", "http://a.net:80/x", "a://b://c.net/", "http://É.net/é", "http://x.net/" + "a" * 50_000, "http://x.net/" + "a" * 50_000, "http://a.net\n/b", "?://net/"]


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host, rest = re.match(r"(?s)([^/?#]*)(.*)", url[at + 3 :]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest)[0]


def rule(host, path):
    best = (None, None)
    for kind, text in url_filters.RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(text) > len(best[0] or ""):
            best = (text, kind)
    return best


def check(rows, urls):
    for r in rows:
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        text, kind = rule(host, path)
        assert r.rule == text and r.verdict in ("block", "allow") and (kind is None or r.verdict == kind)
        assert 0 <= r.score <= 1


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    rows = op1_url_filters(spark, SF).collect()
    check(rows, urls)
    assert len(rows) == len(urls)


def test_edge_cases(spark):
    df = spark.createDataFrame(list(enumerate(EDGE)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("features", F.lit(1))
    rows = url_filters.filter_urls(df).collect()
    check(rows, dict(enumerate(EDGE)))
    assert len(rows) == len(EDGE)
    same = {(r.verdict, r.score) for r in rows if (r.host, r.path) == ("", "")}
    assert len(same) == 1


@pytest.mark.parametrize("labels", [[], [("http://a.b/c", 1)], [("http://a.b/c", 0)]])
def test_nothing_to_tell_apart(spark, labels):
    df = spark.createDataFrame([(1, "http://q.w/e")], "page_id long, url string")
    got = url_filters.filter_urls(df, spark.createDataFrame(labels, "url string, label int")).collect()
    assert [r.verdict for r in got] == ["block" if labels and labels[0][1] else "allow"]
    assert url_filters.filter_urls(df.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    """Learned from half of the pages by the language in the path, the other half is judged right."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url").withColumn("label", F.col("url").rlike("/(de|fr)/").cast("int"))
    got = url_filters.filter_urls(pages.where("page_id % 2 = 0").drop("label"), pages.where("page_id % 2 = 1"), rules=())
    right = got.join(pages, "page_id").agg(F.avg((F.col("verdict") == F.when(F.col("label") == 1, "block").otherwise("allow")).cast("int"))).first()[0]
    assert right >= 0.95
