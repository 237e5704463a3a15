import random

import pytest
from pyspark.sql import functions as F

from textloom.llm import url_filter
from textloom.llm.queries import URL_RULES, op13_url_filter

RULES = "host string, path string, action string"


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


ODD = [None, "", "no scheme", "http://", "://", "http://EXAMPLE.com/en/x?y#z", "a://www.example.com/en", "http://www.example.com/en/",
       "http://x.www.example.com/en/1", "http://com/", "http://com", "http://.com/", "http://a..net/es/", "http://net/es/q", "x://net/fr/?/es/",
       "http://notexample.com/en/", "http://example.com.net/fr/", "http://u@example.com:80/en/", "http://a.com//en/", "http://a.net/ES/", "h://ÄÖ.com/é/",
       "http://a\nb.com/\n", "http://host?x=://example.com/en/", "http://" + "a." * 3000 + "com/" + "p/" * 100_000, "ftp://x://y.net/es/", "http://com?/"]


def judged(spark, urls, rules, **options):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_filter.judge(df, spark.createDataFrame(rules, RULES), **options)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}


def test_odd_urls(spark):
    assert judged(spark, ODD, URL_RULES) == {i: brute(u, URL_RULES) for i, u in enumerate(ODD)}


@pytest.mark.parametrize("bits", [url_filter.FILTER_BITS, 64 * 40])
def test_many_rules_are_exact(spark, bits):
    random.seed(5)
    hosts = [".".join(random.choice("abc") * random.randint(1, 2) for _ in range(random.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/a", "/a/", "/ab/c", "/b"]
    rules = sorted({(h, p): (h, p, random.choice(["allow", "block"])) for h, p in ((random.choice(hosts), random.choice(paths)) for _ in range(90))}.values())
    urls = [f"http://{random.choice(['', 'x.', 'b.'])}{random.choice(hosts)}{random.choice(paths + ['/a/x', '/zz'])}" for _ in range(3000)]
    want = {i: brute(u, rules, "none") for i, u in enumerate(urls)}
    assert judged(spark, urls, rules, default="none", filter_bits=bits) == want
    assert len({w[3] for w in want.values()}) == 3


def test_a_cascade_is_exact_on_its_universe(spark):
    """Levels of one bit in two let through half of what is not listed: later levels must catch it."""
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    listed = keys.where("id % 5 = 0").select("key", F.when(F.col("id") % 2 == 0, "allow").otherwise("block").alias("action"))
    made = url_filter.build(listed, keys.select("key").unionAll(keys.select("key")))
    assert all(len(made[a].levels) > 2 for a in made)
    wrong = keys.where((made["allow"].contains(F.col("key")) != (F.col("id") % 10 == 0)) | (made["block"].contains(F.col("key")) != (F.col("id") % 10 == 5)))
    assert wrong.count() == 0


def test_rules_that_cannot_fit(spark):
    rules = [(None, "/", "block"), ("", "/", "block"), ("com", "x", "block"), ("a.com", None, "block"), ("b.com", "/", "maybe"), ("B.com", "/", "block"), ("b.com", "/", "allow")]
    got = judged(spark, ["http://b.com/", "http://comx", "http://a.com/", None], rules)
    assert [got[i][2:] for i in range(4)] == [("b.com/", "block"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert judged(spark, ["http://b.com/"], [])[0] == ("b.com", "/", None, "allow")
    assert judged(spark, [], URL_RULES) == {}


def test_columns_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/", "x", 5)] * 3, "`key` long, url string, Rule string, action long")
    out = url_filter.judge(df, spark.createDataFrame(URL_RULES, RULES))
    assert out.columns == ["key", "url", "action", "host", "path", "rule", "verdict"]
    assert [tuple(r) for r in out.collect()] == [(1, "http://a.com/", 5, "a.com", "/", "com/", "allow")] * 3


def test_query_uses_expressions_only(spark, data):
    plan = op13_url_filter(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Join", "Exchange"))
