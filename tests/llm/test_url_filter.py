import random

from pyspark.sql import functions as F

from ridelens.llm import url_filter
from ridelens.llm.queries import QUERIES
from tests.conftest import plan_of

SCHEMA = "page_id long, url string, host int, verdict boolean, html string"


def plain(url, rules, default="allow"):
    """host, path, rule and verdict by trying every rule."""
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for mark in "/?#":
            host = host.split(mark, 1)[0]
        path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h) or (h == "")) and path.startswith(p):
            fits.append((len(h + p), len(h), verdict == "block", h + p, verdict))
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], best[4]


def check(spark, urls, rules=url_filter.RULES, table=None):
    pages = spark.createDataFrame([(i, u, 1, True, "<p>") for i, u in enumerate(urls)], SCHEMA)
    got = url_filter.judge(pages, table).collect()
    assert sorted(r.page_id for r in got) == list(range(len(urls)))
    for r in got:
        assert (r.url, r.host, r.path, r.rule, r.verdict) == (urls[r.page_id], *plain(urls[r.page_id], rules))


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "http://NET/x", "https://Example.NET/en/1?x#y",
    "https://a.b.example.net/en/", "https://notexample.net/en/a", "https://example.net/en", "https://example.net/EN/",
    "http://example.com/de/1", "http://www.example.com/de/", "http://example.com/den", "http://org/fr/", "http://x.org/fr/é#/",
    "http://x.org?u=http://example.net/en/", "http://x.org#://net/", "http://x.net/a://example.net/en/", "http://u@x.net:80/",
    "http://x.net:80/", "http://x.net./", "http://.net/", "http://ÄÉ.net/", "ftp://net/a\nb", "http://a\nb.net/c", "http://x.org/fr",
]


def test_default_rules_on_every_kind_of_url(spark):
    check(spark, URLS + URLS)


def test_very_long_urls_and_many_labels(spark):
    check(spark, ["http://" + "a." * 50_000 + "net/" + "x/" * 50_000, "http://example.net/en/" + "é" * 200_000, "x" * 300_000 + "://net/"])


def test_random_rules_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 5)
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
    path = lambda: rng.choice(["", "/"]) + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 4)))
    rules = [(rng.choice(["block", "allow"]), host(), path()) for _ in range(300)] + [("block", "", "/aa"), ("allow", "a.b", "b")]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    check(spark, [f"http://{host()}{path()}" for _ in range(2000)] + [None, "http://"] * 3, rules, table)


def test_equal_prefixes_do_not_decide(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "PREFIX", 1)  # four bits: many rules meet that differ
    rules = [("block", f"h{i}", "/") for i in range(64)]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    check(spark, [f"http://h{i}/" for i in range(0, 200, 3)], rules, table)


def test_no_rules_empty_table_null_ids_and_a_hot_url(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    check(spark, URLS, [], none)
    assert url_filter.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    hot = spark.range(300).select(F.lit(None).cast("long").alias("page_id"), F.lit("http://x.net/").alias("url"))
    assert [(r.rule, r.verdict) for r in url_filter.judge(hot).collect()] == [("net/", "block")] * 300


def test_plan_has_no_python(spark):
    plan = plan_of(QUERIES["op12_url_filter"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    assert "html" not in plan
