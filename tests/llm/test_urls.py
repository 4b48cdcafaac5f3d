from pyspark.sql import functions as F

from locuswise.llm.urls import bloom_filter, url_verdicts, with_maybe

ROWS = [
    (1, "http://WWW.Example.com/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (2, "https://a.example.com/en/x", "a.example.com", "/en/x", "example.com/en/", "block"),
    (3, "https://example.com", "example.com", "", None, "allow"),
    (4, "https://example.com/e", "example.com", "/e", "com/", "allow"),
    (5, "http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    (6, "http://net/fr/", "net", "/fr/", "net/fr/", "block"),
    (7, "http://anet/fr/", "anet", "/fr/", None, "allow"),
    (8, None, "", "", None, "allow"),
    (9, "no scheme", "", "", None, "allow"),
    (10, "", "", "", None, "allow"),
    (11, "http://m.bad.org/x.html?q=1", "m.bad.org", "/x.html", None, "block"),
    (12, "https://bad.org/x/", "bad.org", "/x/", None, "block"),
    (12, "https://bad.org/x/", "bad.org", "/x/", None, "block"),
    (13, "https://bad.org/y", "bad.org", "/y", None, "allow"),
    (None, "ftp://İ.org?a/b", "İ.org", "", None, "allow"),
    (14, "?://q#r://s/t", "q", "", None, "allow"),
]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(*r[:2], "clash", True) for r in ROWS], "page_id long, url string, host string, listed boolean")
    listed = spark.createDataFrame([("bad.org/x",), ("bad.org/x",), (None,), ("",)], "canonical string")
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted((tuple(r) for r in url_verdicts(pages, listed).select("page_id", "host", "path", "rule", "verdict").collect()), key=key)
    assert got == sorted(((r[0], *r[2:]) for r in ROWS), key=key)
    assert url_verdicts(pages.limit(0), listed).count() == 0
    assert url_verdicts(pages, listed.limit(0)).filter("verdict = 'block'").count() == 3


def test_filter_has_no_false_negative(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    urls = spark.range(20000).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    blocks = 3000 * 16 // 512
    for broadcast in (True, False):
        got = with_maybe(urls, bloom_filter(listed, blocks), blocks, broadcast).filter("maybe")
        assert got.join(listed, "canonical").count() == 3000
        assert got.count() < 3000 + 17000 * 0.02
