import re

from tallyloom.llm import url_filter
from tallyloom.llm.catalog import QUERIES


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")):
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, best


URLS = [None, "", "example.net/en/", "http://EXAMPLE.net/en/x?y#z", "http://a.example.net/en", "https://net/", "http://net", "x://y://net/", "http://notnet/", "http://a.net?x=/en/",
        "http://a.org/fr/", "http://org/fr/", "http://b.example.com/de/1", "http://b.example.com/DE/1", "http://ÄB.net/é", "http://a.net\n/x", "://h.org/fr/#a", "http://q.org/en/", "http://q.org/en/"]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, n int")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, best = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best[0] if best else None), u
        assert got[i].verdict == best[1] if best else got[i].verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op7_url_filter"](spark, folder).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, best = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        if best:
            assert r.verdict == best[1]


def test_shrinkage(spark):
    rows = [("a.x.com", 90, 100), ("b.x.com", 1, 1), ("c.x.com", 0, 0), ("a.y.com", 0, 200), ("b.y.com", 1, 1), ("c.y.com", 0, 0), ("", 0, 0)]
    got = {r.host: r for r in url_filter.reputation(spark.createDataFrame(rows, "host string, bad long, n long")).collect()}
    assert got["a.x.com"].mean > 0.85 and got["a.y.com"].mean < 0.05
    # One bad page says little: the host stays near its domain.
    assert got["b.y.com"].mean < got["b.x.com"].mean
    assert got["c.y.com"].mean < got["b.y.com"].mean
    assert got["c.x.com"].sd > got["a.x.com"].sd
    assert 0 <= got[""].mean <= 1


def test_suffixes_of_two_labels(spark):
    rows = [("a.x.co.uk", 90, 100), ("c.x.co.uk", 0, 0), ("a.y.co.uk", 0, 200), ("c.y.co.uk", 0, 0), ("co.uk", 0, 0), ("x.uk", 0, 3)]
    outcomes = spark.createDataFrame(rows, "host string, bad long, n long")
    got = {r.host: r.mean for r in url_filter.reputation(outcomes).collect()}
    assert len(got) == len(rows) and got["c.x.co.uk"] > got["c.y.co.uk"]
    strangers = {r.host: r.mean for r in url_filter.reputation(outcomes, suffixes=()).collect()}
    assert strangers["c.x.co.uk"] == strangers["c.y.co.uk"]


def test_names_of_own_columns_and_long_urls(spark):
    rows = [(i, u, "p", "p", "p", "p") for i, u in enumerate(["http://a.net/" + "x" * 200_000, "http://" + "a." * 50_000 + "org/fr/", "http://b.co.uk/?" + "y" * 200_000, None])]
    df = spark.createDataFrame(rows, "page_id long, url string, ruled string, domain string, suffix string, host string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert [got[i].rule for i in range(4)] == ["net/", "org/fr/", None, None]
    assert len(got[0].path) == 200_001 and got[2].host == "b.co.uk" and got[3].host == got[3].path == ""
