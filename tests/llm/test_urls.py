"""URL rules against a plain reading of them."""

import re

from pairworks.llm import urls
from pairworks.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_like_plain_reading(spark):
    given = ["http://ORG/", "x", None, "", "http://a.example.org/es/x?y", "https://example.org/en/1234", "//com/fr/", "a://b.com/de/#x", "a://b.com/de/#x", "://com",
             "http://EXAMPLE.org:80/es/", "http://notexample.org/es/", "http://x.y.z.example.org/en/2", "http://com/fr/?a://b", "h://É.com/de/é", "http://.com/fr/",
             "http://" + "a." * 2000 + "com/de/" + "b" * 5000]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(given)], "page_id long, url string, host string")
    got = urls.report(pages, spark.createDataFrame(URL_RULES, RULES)).collect()
    assert sorted(map(tuple, got)) == [(i, *plain(u)) for i, u in enumerate(given)] or sorted(map(tuple, got), key=str) == sorted(((i, *plain(u)) for i, u in enumerate(given)), key=str)


def test_columns_rules_and_empty(spark):
    pages = spark.createDataFrame([(None, "http://a.com/x", 1), (None, "http://a.com/x", 1)], "page_id long, url string, judged int")
    both = spark.createDataFrame([("a.com", "/", "allow"), ("A.com", "/", "block"), (None, "/", "block")], RULES)
    assert [tuple(r.judged_) for r in urls.judge(pages, both).collect()] == [("a.com", "/x", "a.com/", "block")] * 2
    assert urls.allowed(pages, both).collect() == [] and urls.allowed(pages, both).columns == pages.columns
    assert urls.judge(pages, both.limit(0)).where("judged_.verdict = 'allow'").count() == 2
    assert urls.report(pages.limit(0), both).collect() == []
