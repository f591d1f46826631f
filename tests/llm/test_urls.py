import re

from pricewatch.llm import urls
from pyspark.sql import functions as F

URLS = [
    None, "", "no scheme.net/x", "://", "http://A.NET", "http://a.net/", "http://net/x", "https://xnet/", "http://sub.example.net/en/1", "http://example.net/enx",
    "http://example.com/de/1?x#y", "http://m.example.com/de", "http://b.org/fr/1", "http://b.org/FR/1", "ftp://É.ORG/fr/", "http://a?q=://b.net/", "http://x.net#/en/", "http://h/p://q/r", "a\nb://x.net/y\nz?",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for _, rule in urls.RULES:
        site, _, begin = rule.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + begin) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, "http://a.net/", "x", "y")], "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = urls.judge(pages, labels)
    assert out.columns[:4] == pages.columns
    got = sorted((r["page_id"], r["host_"], r["path"], r["rule"], r["verdict_"]) for r in out.withColumn("rule", F.coalesce("rule", F.lit(""))).collect())
    verdicts = {rule: v for v, rule in urls.RULES}
    want = sorted((i, *brute(u)[:2], brute(u)[2] or "", verdicts.get(brute(u)[2], "allow")) for i, u in [*enumerate(URLS), (3, "http://a.net/")])
    assert got == want


def test_templates_split_only_where_purity_differs(spark):
    pages, labels = [], []
    for i in range(600):
        branch = ("spam", "news", "blog")[i % 3]
        pages.append((i, f"https://site.com/{branch}/{i}.html"))
        labels.append((i, int(branch != "spam" or i % 30 == 0), 0))
    pages += [(1000 + i, f"https://site.com/rare{i}/x") for i in range(5)] + [(2000, "https://site.com/" + "/".join("abcdefghijkl"))]
    out = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"))
    rows = {r.page_id: r for r in out.collect()}
    assert len(rows) == len(pages)
    assert {rows[i].verdict for i in range(0, 600, 3)} == {"block"} and rows[0].template == "/spam/*.html"
    assert {rows[i].verdict for i in range(600) if i % 3} == {"allow"}
    assert {rows[1000 + i].template for i in range(5)} == {"/*/*"}
    assert abs(rows[0].purity - (20 + 10 * rows[1000].purity) / 210) < 0.05
    assert rows[2000].verdict == "allow"


def test_branches_below_a_deep_prefix_are_compared(spark):
    deep, pages, labels = "/".join("abcdefghijk"), [], []
    for i in range(200):
        branch = ("spam", "news")[i % 2]
        pages.append((i, f"https://site.com/{deep}/{branch}/{i}.html"))
        labels.append((i, i % 2, 0))
    pages += [(1000, f"https://alone.com/{deep}/x9.html"), (1001, "https://alone.com/")]
    out = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = {r.page_id: r for r in out.collect()}
    assert {rows[i].verdict for i in range(0, 200, 2)} == {"block"} and {rows[i].verdict for i in range(1, 200, 2)} == {"allow"}
    assert rows[0].template == "/*" * 11 + "/spam/*.html"
    assert rows[1000].template == "/*" * 11 + "/*.html" and rows[1001].template == ""


def test_empty(spark):
    out = urls.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert out.count() == 0
