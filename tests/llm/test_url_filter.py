from __future__ import annotations

import math
import re
from collections import Counter

from broadsheet.llm import url_filter as uf
from broadsheet.llm.queries import URL_RULES, op10_url_filter
from pyspark.sql import functions as F
from tests.test_registered import DATA


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


ODD = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x", "http://xexample.com/en/", "https://a.net/es",
    "https://a.net/es/?q=://b.com/", "http://example.com/en/../#/en/", "ftp://u:p@h.net:80/fr/1?a=1&b&&c=%20#x", "http://É.net/fr/é", "x" * 50_000,
    "http://a.net?x", "http://a.net#/es/", "http://www.example.com/en/",
]


def test_rules_on_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(ODD)] + [(3, ODD[3], "h")], "page_id long, url string, host string")
    out = uf.judged(pages, URL_RULES).collect()
    assert len(out) == len(ODD) + 1
    for r in out:
        host, path, rule, verdict = plain(ODD[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")


def test_lexical_features(spark):
    url = "http://a-b.example.com/x1/y22/?p=1&q&&r=%20#f"
    df = spark.createDataFrame([(url,), (None,)], "url string")
    df = df.select("url", uf.host_of(F.col("url")).alias("h"), uf.path_of(F.col("url")).alias("p"))
    got, empty = df.select(*uf.lexical(F.col("url"), F.col("h"), F.col("p"))).collect()
    share = [n / len(url) for n in Counter(url).values()]
    want = {
        "url_length": len(url), "host_length": 15, "path_length": 8, "host_labels": 3, "depth": 2, "parameters": 3,
        "digit_ratio": sum(c.isdigit() for c in url) / len(url), "entropy": -sum(p * math.log2(p) for p in share),
        "fragment": 1, "escapes": 1, "hyphens": 1, "longest_label": 7,
    }
    for name, value in want.items():
        assert abs(got[name] - value) < 1e-9, name
    assert not any(empty.asDict().values())


def test_learns_from_rules_and_without_them(spark):
    rows = [(i, f"http://h{i % 7}.{'com/a' if i % 2 else 'net/fr/b'}/{i}") for i in range(200)]
    rows += [(1000, "http://x.org/fr/b/7"), (1001, "http://h1.com.org/a/9")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in uf.judged(pages, URL_RULES).collect()}
    assert all(verdicts[i] == ("allow" if i % 2 else "block") for i in range(200))
    assert {r["verdict"] for r in uf.judged(pages, []).collect()} == {"allow"}
    assert {r["verdict"] for r in uf.judged(pages, [uf.Rule("block", "net", "/")]).collect()} == {"block"}
    assert uf.judged(pages.limit(0), URL_RULES).count() == 0


def test_query(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    df = op10_url_filter(spark, DATA)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])


def test_shares_count_all_labelled_urls(spark, monkeypatch):
    kept = {}
    stored = uf.stored

    def keeping(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(uf, "stored", keeping)
    monkeypatch.setattr(uf, "SAMPLE", 5)
    rows = [(i, f"http://h{i % 7}.{'com/a' if i % 4 else 'net/fr/b'}/{i}") for i in range(80)]
    pages = spark.createDataFrame(rows + rows[:9] + [(1000, "http://h1.org/9")], "page_id long, url string")
    assert uf.judged(pages, URL_RULES).count() == 90
    labels = {}
    for _, url in rows:
        labels.setdefault(".".join(plain(url)[0].split(".")[-1:]), []).append(plain(url)[3] == "block")
        labels.setdefault(plain(url)[0], []).append(plain(url)[3] == "block")
    share = {k: (sum(v) + uf.SMOOTHING * 20 / 80) / (len(v) + uf.SMOOTHING) for k, v in labels.items()}
    got = {r["suffix"]: r["share"] for r in kept["suffixes"].collect()}
    assert got.keys() == share.keys() and all(abs(got[k] - share[k]) < 1e-12 for k in got)
    weights = {}
    for r in kept["examples"].collect():
        weights.setdefault(r["label"], []).append(r["weight"])
    assert weights == {0.0: [12.0] * 5, 1.0: [4.0] * 5}


def test_few_urls_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(uf, "SAMPLE", 100)
    urls = spark.range(20_000).select(F.concat(F.lit("http://a.net/"), "id").alias("url"), (F.col("id") % 4 == 0).cast("double").alias("label"))
    few = uf.candidates(urls, {0.0: 15_000, 1.0: 5_000})
    for label in (0.0, 1.0):
        least = urls.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(100)
        assert 100 <= few.where(F.col("label") == label).count() <= 300
        assert least.join(few, "url", "left_anti").count() == 0
    assert uf.candidates(urls, {0.0: 150, 1.0: 5_000}).where("label = 0").count() == 15_000


def test_only_few_urls_reach_the_window(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(uf, "SAMPLE", 50)
    monkeypatch.setattr(uf, "candidates", lambda df, counts, f=uf.candidates: seen.append(f(df, counts).count()) or f(df, counts))
    pages = spark.createDataFrame([(i, f"http://h.{'com/a' if i % 2 else 'net/fr/b'}/{i}") for i in range(2000)], "page_id long, url string")
    assert uf.judged(pages, URL_RULES).count() == 2000
    assert 100 <= seen[0] <= 300
