from pyspark.sql import functions as F

from telemetry_spark.llm import urls
from telemetry_spark.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:end]


def rule_of(host, path):
    fits = [(len(h) + len(p), v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def check(rows):
    for r in rows:
        host, path = parts(r.url)
        verdict, rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict in (None, r.verdict)


def test_rules_and_trees(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    found = urls.judge(pages, URL_RULES)
    rows = found.join(pages.select("page_id", "url"), "page_id").collect()
    check(rows)
    assert len(rows) == pages.count()


def test_the_trees_learn_the_suffix(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(
        F.lit("https://h"), F.col("id") % 50, F.when(F.col("id") % 2 == 0, ".spam.net/en/").otherwise(".good.org/fr/"), F.col("id")).alias("url"))
    new = spark.createDataFrame([(9000, "https://a.spam.com/x"), (9001, "https://h3.good.org/de/77")], "page_id bigint, url string")
    found = {r.page_id: r for r in urls.judge(pages.unionByName(new), URL_RULES).collect()}
    assert found[9001].rule is None and found[9001].verdict == "allow"
    right = [(r.block_probability > 0.5) == (r.verdict == "block") for r in found.values() if r.rule]
    assert sum(right) > 0.99 * len(right)


def test_odd_rows(spark):
    odd = [
        (1, None), (2, ""), (3, "no host"), (4, "http://A.NET"), (5, "http://a.net/"), (6, "HTTPS://x.Example.NET/en/1?u=http://b.org/fr/"),
        (7, "http://example.net/en"), (8, "http://notnet/"), (9, "a://b.org/fr/x#y"), (None, "http://net/"), (5, "http://a.net/"),
        (10, "http://" + "a" * 50000 + ".org/fr/"), (11, "x\n://a.org/fr/\nz"), (12, "http://example.com/de/?"),
    ]
    pages = spark.createDataFrame(odd, "page_id bigint, url string").withColumns({"host": F.lit("h"), "features": F.lit(1), "bad": F.lit(2)})
    found = urls.judge(pages, URL_RULES)
    by_id = {k: u for k, u in odd}
    rows = [type("R", (), {"url": by_id[r.page_id], **r.asDict()}) for r in found.collect()]
    check(rows)
    assert len(rows) == len(odd)
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages.where("page_id < 4"), URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in urls.judge(pages.where("page_id in (1, 5)"), URL_RULES).collect()} == {"block"}
