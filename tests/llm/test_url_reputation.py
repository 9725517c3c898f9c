"""URL rules and host reputation."""

import pytest
from pyspark.sql import functions as F

from eventtally.llm.url_reputation import host_reputation, judge_urls

URLS = [
    ("http://WWW.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("https://example.com/en", "example.com", "/en", "com/", "allow"),
    ("https://x.net/fr/1", "x.net", "/fr/1", "net/fr/", "block"),
    ("net://net/es/", "net", "/es/", "net/es/", "block"),
    ("https://x.com", "x.com", "", None, "allow"),
    ("https://x.com?/en/", "x.com", "", None, "allow"),
    ("https://x.com:80/en/", "x.com:80", "/en/", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://\nİ.org/\n?x", "\nİ.org", "/\n", None, "allow"),
]


def test_hosts_paths_and_rules(spark):
    rows = [(k, u) for k, (u, *_) in enumerate(URLS)] + [(0, URLS[0][0]), (None, "http://" + "a" * 200_000 + ".net/fr/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'mine' as host", "1 as rule", "2 as lowest2")
    found = judge_urls(pages, pages.select("url", F.lit(None).cast("boolean").alias("bad"))).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["page_id"] is None:
            assert (r["rule"], r["verdict"], len(r["host"])) == ("net/fr/", "block", 200_004)
        else:
            assert (r["url"], r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["page_id"]]
    assert judge_urls(pages.limit(0), pages.limit(0).select("url", F.lit(True).alias("bad"))).count() == 0


@pytest.fixture(scope="module")
def rates(spark):
    rows = [("bad.org", True)] * 60 + [("new.bad.org", None), ("good.org", False), ("other.net", None)]
    rows += [(f"h{k}.org", k % 10 == 0) for k in range(200)] + [("one.org", True)]
    found = host_reputation(spark.createDataFrame(rows, "host string, bad boolean"))
    return {r["host"]: r for r in found.collect()}


def test_rates_are_shrunk(rates):
    assert rates["bad.org"]["rate"] > 0.8 and rates["bad.org"]["lowest"] > 0.5
    # One bad page says little; a host without labels has its domain's rate.
    assert rates["one.org"]["rate"] < 0.9 and rates["one.org"]["lowest"] < 0.25
    assert rates["new.bad.org"]["rate"] > 0.5 > rates["h1.org"]["rate"]
    assert all(0 <= r["rate"] <= 1 and r["lowest"] <= r["rate"] for r in rates.values())


def test_pages_of_bad_hosts_are_blocked(spark):
    outcomes = spark.createDataFrame([("http://bad.org/", True)] * 80 + [(f"http://ok{k}.org/", False) for k in range(300)], "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://bad.org/x"), (2, "http://ok3.org/x"), (3, "http://unseen.org/")], "page_id long, url string")
    unseen = outcomes.unionByName(pages.select("url", F.lit(None).cast("boolean").alias("bad")))
    found = {r["page_id"]: r["verdict"] for r in judge_urls(pages, unseen).collect()}
    assert found == {1: "block", 2: "allow", 3: "allow"}
    # A host that no outcome names is allowed too.
    assert {r["page_id"]: r["verdict"] for r in judge_urls(pages, outcomes).collect()} == found


def test_clashing_columns_stay(spark):
    """Names of the result are replaced, all others stay, also those of steps in between."""
    names = "page_id long, url string, lowest string, _rate int, rate int, page int, rule string, `_host` int"
    pages = spark.createDataFrame([(1, "http://a.com/x", "l", 2, 3, 4, "r", 5)], names)
    found = judge_urls(pages, pages.select("url", F.lit(True).alias("bad")))
    assert found.columns == ["page_id", "url", "lowest", "_rate", "rate", "page", "_host", "host", "path", "host_rate", "rule", "verdict"]
    row = found.first()
    assert (row["lowest"], row["_rate"], row["rate"], row["page"], row["_host"], row["rule"], row["host"]) == ("l", 2, 3, 4, 5, "com/", "a.com")
