"""URL rules against a plain version, and the cases a digest could get wrong."""

import random

import numpy as np
import pytest

from eventloom.llm import catalog, url_filter

RULES = [*catalog.RULES, ("example.org", "/es/", "allow"), ("b.example.org", "", "block"), ("net", "/é", "block")]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([k for k in (rest.find(c) for c in "?#") if k >= 0], default=len(rest))]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), v == "block")
            best = max(best or (rank, h + p, v), (rank, h + p, v))
    return host, path, best and best[1], best[2] if best else "allow"


def urls():
    rnd = random.Random(4)
    hosts = ["example.org", "EXAMPLE.org", "a.b.example.org", "b.example.org", "notexample.org", "org", "x.com", "com", "foo.net", "", "é.net", "ÀB.com"]
    tails = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/es/", "/fr/x#y", "/de/", "?/de/", "#/fr/", "/é", "//es/"]
    out = [None, "", "example.org/es/", "://", "x://y://org/", "http:///es/", "https://" + "a." * 300 + "org/" + "x" * 5000]
    return out + [f"http://{rnd.choice(hosts)}{rnd.choice(tails)}" for _ in range(300)]


@pytest.mark.parametrize("most", [url_filter.MAX_INDEX_BYTES, 0])
def test_both_ways_equal_the_plain_version(spark, most):
    rows = urls() * 2
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string").selectExpr("*", "'old' AS Rule", "1 AS host")
    got = url_filter.verdicts(df, RULES, max_index_bytes=most)
    assert sorted(c.lower() for c in got.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    for r in got.collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, RULES), r.url


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_filter.verdicts(df, []).first().verdict == "allow"
    assert url_filter.verdicts(df.limit(0), RULES).count() == 0
    assert url_filter.verdicts(df, [(None, "/", "block")], default="block").first().verdict == "block"


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: len(s) % 2)
    index = url_filter.Index(url_filter.build_index([(f"h{k}.org", "/", "block") for k in range(40)], str(tmp_path)))
    keys = ["h3.org/", "h39.org/", "h40.org/", "h4.net/", "x"]
    found = index.find(keys, np.array([len(k) % 2 for k in keys], np.uint64))
    assert [index.stored(k).decode() if k >= 0 else None for k in found] == ["h3.org/", "h39.org/", None, None, None]


def test_the_query_equals_its_sql(spark):
    from compare import compare, duck

    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), sf, catalog.QUERIES["op1_url_filter"], catalog.ORACLES["op1_url_filter"]) == ""
