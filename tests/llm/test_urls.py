"""URL filter: hosts, paths, rules, the Bloom filter and its false positives."""

from __future__ import annotations

import re

import numpy as np
import pytest

import __spark_entry__ as contract
from forecourt.llm import urls

SMALL = "/root/testdata/sf0.001"
URLS = [
    "http://net/", "https://a.NET/x", "http://a.net", "http://a.net?q=/", "http://www.example.net/en/1", "http://example.net/en", "http://xexample.net/en/",
    "http://b.EXAMPLE.com/de/7#x", "http://example.com/de", "http://q.org/fr/", "http://org/fr/x", "http://torg/fr/x", "ftp://u:p@h.net:80/a://b/?c", "http://É.net/É",
    "http://spam.com/a.html", "http://www.spam.com/a/", "http://m.spam.com:443/a?x", "http://spam.com/b", "http://SPAM.com/A", "no scheme.net/", "", "://", "://net", "http:///net/", None, " http://net/ ", "http://net\n/x", "http://..net/", "http://" + "a." * 500 + "net/" + "p" * 5000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain(url, rules, listed):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    name = re.sub(r"^(www|m)\.", "", re.sub(r":(80|443)$", "", host)) + re.sub(r"(/index\.html|\.html|/)$", "", path)
    return host, path, None, "block" if host and name in listed else "allow"


def frames(spark, rules, listed):
    return spark.createDataFrame(rules, "host string, path string, verdict string"), spark.createDataFrame([(x,) for x in listed], "url string")


def judged(spark, pages, rules, listed, **more):
    frame = spark.createDataFrame([(i, u, "h", "p", "k") for i, u in pages], "page_id bigint, url string, host string, path string, keys string")
    return [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(frame, *frames(spark, rules, listed), **more).collect()]


@pytest.mark.parametrize("size", [{}, {"max_blocks": 1, "bits_per_key": 1}])
def test_rules_and_list(spark, size):
    rules = [*urls.RULES, ("deep.example.net", "/en/1", "block"), ("É.net", "/", "allow"), ("", "/", "block"), (None, "/", "block"), ("com", "/", "maybe"), ("a.b", None, "allow")]
    listed = ["spam.com/a", "spam.com/a", "q.org/fr", "", None]
    pages = [*enumerate(URLS), (3, URLS[3]), (3, "http://other.net/"), (None, URLS[0]), (None, URLS[0])]
    want = [(i, *plain(u, [r for r in rules if r[0] and r[1] and r[2] != "maybe"], set(listed) - {"", None})) for i, u in pages]
    got = judged(spark, pages, rules, listed, **size)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_equal_entries_block_and_longer_hosts_win(spark):
    rules = [("a.com", "/x", "allow"), ("a.com", "/x", "block"), ("b.a.com", "/", "allow"), ("a.com", "/ab", "block")]
    got = judged(spark, [(1, "http://a.com/x1"), (2, "http://b.a.com/abc"), (3, "http://a.com/abc")], rules, [])
    assert sorted((i, rule, v) for i, _, _, rule, v in got) == [(1, "a.com/x", "block"), (2, "b.a.com/", "allow"), (3, "a.com/ab", "block")]


def test_empty_tables(spark):
    assert judged(spark, [], urls.RULES, ["x"]) == []
    assert [r[3:] for r in judged(spark, [(1, "http://net/"), (2, None)], [], [])] == [(None, "allow")] * 2


def test_filter_knows_its_keys_and_few_others(spark):
    _, listed = frames(spark, [("x", "/", "block")], [f"site{i}.com/p{i % 7}" for i in range(5000)])
    entries = urls.entries_of(*frames(spark, [("x", "/", "block")], [f"site{i}.com/p{i % 7}" for i in range(5000)]))
    blocks = urls.bloom_filter(entries)
    hashes = lambda frame: [np.array(c) for c in zip(*frame.select(*urls._hashes(frame["key"])).collect(), strict=True)]
    assert blocks.size * 64 >= 5001 * urls.BITS_PER_KEY
    assert urls.contains(blocks, *hashes(entries)).all()
    others = spark.range(20_000).selectExpr("concat('uother', id, '.com/') as key")
    assert urls.contains(blocks, *hashes(others)).mean() < 0.01
    assert listed.count() == 5000


def test_hot_listed_url(spark):
    """A third of all pages under one key, with entries too many to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = [(i, "http://hot.com/x" if i % 3 else f"http://h{i}.com/y") for i in range(900)]
        got = judged(spark, pages, [("hot.com", "/z", "allow")], ["hot.com/x", "h3.com/y"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {i for i, *_, v in got if v == "block"} == {i for i in range(900) if i % 3 or i == 3}


def test_query_against_plain(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in contract.queries()["op11_urls"](spark, SMALL).collect()}
    listed = {urls_name(r["url"]) for r in rows if set(parts(r["url"])[0].split(".")) & set(urls.LISTED_NAMES)}
    assert listed and got == {r["page_id"]: plain(r["url"], urls.RULES, listed) for r in rows}


def urls_name(url):
    host, path = parts(url)
    return re.sub(r"^(www|m)\.", "", host) + re.sub(r"(/index\.html|\.html|/)$", "", path)
