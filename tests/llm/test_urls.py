"""URL rules and the list against plain Python."""

from pyspark.sql import functions as F

from bourse.llm import urls

CASES = [None, "", "no scheme", "http://EXAMPLE.com/en/1", "https://www.example.com/en/1?x", "http://a.b.example.com/en", "http://example.com",
         "http://x.net/es/1#t", "http://net/fr/", "http://xnet/fr/", "http://example.org/a/", "http://m.example.org/a.html?q", "ftp://casino.example.org/z",
         "http://www.casino.example.org/z/", "http://É.com/x", "a://b://c/d", "http://?q", "http://my-pills.org/en/1", "http://notcom/x"]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit)[2:] if fit else (None, None)
    bare = next((host[len(w):] for w in ("www.", "m.") if host.startswith(w)), host)
    short = path.removesuffix("/").removesuffix(".html")
    return host, path, rule, verdict, bare + short


def pages(spark):
    rows = [(k, url, "x", 1, True) for k, url in enumerate(CASES * 3)]
    return spark.createDataFrame(rows, "page_id long, url string, key string, word long, maybe boolean")


def test_verdicts(spark):
    table = pages(spark)
    listed = ["example.org/a", "casino.example.org/z", "", "elsewhere.org/q"]
    found = urls.judged(table, spark.createDataFrame([(u,) for u in listed * 2], "canonical string"))
    got = {r["page_id"]: tuple(r)[1:] for r in found.collect()}
    assert len(got) == found.count() == 3 * len(CASES)
    for k, url in enumerate(CASES * 3):
        host, path, rule, verdict, canonical = brute(url)
        assert got[k] == (host, path, rule, verdict or ("block" if canonical and canonical in listed else "allow")), url


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h"), "id").alias("canonical"))
    asked = spark.range(20000).select(F.concat(F.lit("h"), "id").alias("canonical"), F.lit(0).alias("word"), "id")
    found = urls.possible(asked.drop("word"), listed, 5000)
    assert found.where("id < 5000 and not maybe").count() == 0
    assert found.where("id >= 5000 and maybe").count() < 15000 * 0.1


def test_larger_lists_are_not_broadcast(spark, monkeypatch, rows):
    table = pages(spark)
    listed = urls.listed_by_name(table)
    once = rows(urls.judged(table, listed))
    monkeypatch.setattr(urls, "BROADCAST_BYTES", 0)
    assert rows(urls.judged(table, listed)) == once


def test_empty_tables(spark, rows):
    table = pages(spark)
    assert rows(urls.judged(table.limit(0), urls.listed_by_name(table))) == []
    assert {r["verdict"] for r in urls.judged(table.where("url like '%example.org%'"), urls.listed_by_name(table.limit(0))).collect()} == {"allow"}
