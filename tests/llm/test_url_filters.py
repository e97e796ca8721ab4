import os

import pytest
from pyspark.sql import functions as F

from cardledger.llm import url_filters as op
from cardledger.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, rule string"

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "https://a.example.com/en/1?x=/net/es/",
    "x://example.com/en", "x://example.com/en/#f", "x://example.com", "x://example.com?q", "x://com/", "x://notexample.com/en/",
    "x://b.net/es/1", "x://net/fr/", "x://b.net/esx/", "x://b.org/en/", "a://b://c.net/es/", "x://É.net/es/é", "x://.com/", "x://a..com/p",
    "x://com.:80/", "x://user@www.example.com/en/", "x://www.example.com/en/1\nnext",
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def brute(url, rules, addresses):
    host, path = parse(url)
    best = None
    for rule, verdict in rules:
        rule_host, _, rest = rule.partition("/")
        rule_path = rule[len(rule_host) :]
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            place = (len(rule), len(rule_host), verdict == "block")
            best = max(best or (place, rule, verdict), (place, rule, verdict))
    if best:
        return host, path, best[1], best[2]
    return host, path, None, "block" if host + path in addresses else "allow"


@pytest.mark.parametrize("most_bits", [op.MOST_BITS, 64])
def test_against_all_rules(frame, monkeypatch, most_bits):
    rules = [*URL_RULES, ("b.org", "block"), ("b.org", "allow"), ("example.com/en/", "block")]
    addresses = ["www.example.com/en/x", "notexample.com/en/", "a..com/p", "b.net/esx/"]
    if most_bits == 64:  # each list takes several parts
        monkeypatch.setattr(op, "parts_for", lambda a, b: 3)
    pages = frame([(i, u, "h", "x", "y") for i, u in enumerate(URLS)] + [(0, None, None, None, None)], SCHEMA)
    got = op.judge(pages, frame(rules + [(None, "block")], "rule string, verdict string"), frame([(a,) for a in addresses + [None]], "address string"))
    rows = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in got.collect())
    want = [(i, *brute(u, rules, addresses)) for i, u in enumerate(URLS)] + [(0, *brute(None, rules, addresses))]
    assert rows == sorted((i, h, p, r or "", v) for i, h, p, r, v in want)


def test_cascade_is_exact_over_its_universe(frame):
    keys = frame([("key%d" % i,) for i in range(4000)], "key string")
    listed = frame([("key%d" % i,) for i in range(0, 4000, 7)], "key string")
    cascade = op.Cascade(listed, keys)
    assert len(cascade.levels) > 2
    inside = keys.where(cascade.contains(F.col("key"))).collect()
    assert sorted(r.key for r in inside) == sorted("key%d" % i for i in range(0, 4000, 7))


def test_empty_tables(frame):
    pages = frame([], SCHEMA)
    rules, addresses = frame([], "rule string, verdict string"), frame([], "address string")
    assert op.judge(pages, rules, addresses).count() == 0
    got = op.judge(frame([(1, "x://a.net/es/", "", "", "")], SCHEMA), rules, addresses).first()
    assert (got.rule, got.verdict) == (None, "allow")


def test_mirrored(frame):
    rows = [(1, "x://b/1", "same", "", ""), (2, "x://a/1", "same", "", ""), (3, "x://a/1", "same", "", ""), (4, None, "same", "", ""), (5, "x://c/", None, "", "")]
    assert [r.address for r in op.mirrored(frame(rows, SCHEMA)).collect()] == ["b/1"]


def test_article(frame):
    html = ["<p><ARTICLE id=1>\na</article>b</Article>c", "<article>x", "<articles>x</article>", "", None, "<article\n></article>"]
    df = frame([(i, None, h, "", "") for i, h in enumerate(html)], SCHEMA)
    got = {r.page_id: r.a for r in df.select("page_id", op.article(F.col("html")).alias("a")).collect()}
    want = ["<ARTICLE id=1>\na</article>b</Article>", None, None, None, None, "<article\n></article>"]
    assert [got[i] for i in range(len(html))] == want


def test_mirrors_by_article(frame):
    def page(i, url, article, own):
        return i, url, f"<html><script>track({own})</script>{article}</html>", "", ""

    a, b = "<article>a</article>", "<article>b</article>"
    rows = [page(1, "x://b/1", a, 1), page(2, "x://a/1", a, 2), page(3, "x://c/1", a, 3), page(4, "x://d/1", b, 4), page(5, "x://e/1", "none", 5), page(6, "x://f/1", "none", 5)]
    pages = frame(rows, SCHEMA)
    assert op.mirrored(pages).collect()[0].address == "f/1"
    found = op.mirrored(pages, content=op.article(F.col("html")))
    assert sorted(r.address for r in found.collect()) == ["b/1", "c/1"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_the_list_of_the_given_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    listed = op.mirrored(pages, content=op.article(F.col("html"))).withColumnRenamed("address", "key")
    host, path = op.host_and_path(F.col("url"))
    universe = pages.select(F.concat(host, path).alias("key")).distinct()
    n = listed.count()
    assert n > 100
    cascade = op.Cascade(listed, universe)
    assert len(cascade.levels) >= 3
    inside = universe.where(cascade.contains(F.col("key")))
    assert inside.count() == n and inside.join(listed, "key", "left_anti").isEmpty()
