import json

import pytest
from pyspark.sql import functions as F

from eventloom.functions import url
from eventloom.operators import agent, geo, traffic

RULES = [
    {"url": "google.com", "source": "google", "category": "Search", "params": ["q"]},
    {"url": "shop.example.co", "source": "shop", "category": "Shopping"},
    {"url": "news.org/video", "source": "newsvideo", "category": "Video"},
    {"url": "news.org", "source": "news", "category": "Referral"},
]


def urls(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, u string")


@pytest.mark.parametrize("text,host,path,q", [
    ("https://a.org/x%20y?b=1#f", "a.org", "/x y", "b=1"), ("a.org/p", "a.org", "/p", None), ("http://a.org", "a.org", "", None),
    ("http://u:p@a.org:8080/z", "a.org", "/z", None), ("https://a.org/a|b?c={d}", "a.org", "/a|b", "c={d}"), ("", None, None, None)])
def test_url_parts(spark, text, host, path, q):
    r = urls(spark, text).select(url.host(F.col("u")), url.path(F.col("u")), url.query(F.col("u"))).first()
    assert tuple(r) == (host, path, q)


def test_query_parameters(spark):
    p = url.pairs(F.lit("a=1&b=&c&a=2&d=x%20y+z&=v&e=%zz"))
    r = spark.range(1).select(url.params(p).alias("m"), url.first_param(p, "a").alias("a"), url.first_param(p, "b").alias("b")).first()
    assert r["m"]["a"] == "1,2" and r["m"]["d"] == "x y z" and r["m"]["e"] == "%zz" and (r["a"], r["b"]) == ("1", None)


@pytest.mark.parametrize("page,want", [
    ("x.org?utm_source=a&utm_medium=b", ("a", "b", None)), ("x.org?gclid=1", ("Google", "(CPC)", "gclid")),
    ("x.org?msclid=1&utm_medium=m", ("msclid", "m", "msclid")), ("x.org?utm_source=a&gclid=1", ("a", None, "gclid")),
    ("x.org", (None, None, None)), (None, (None, None, None))])
def test_campaign(spark, page, want):
    t = urls(spark, page).select(traffic.utm(F.col("u")).alias("t")).first()["t"]
    assert (t["source"], t["medium"], json.loads(t["clid"])["type"] if t["clid"] else None) == want


@pytest.mark.parametrize("referrer,want", [
    ("https://www.google.com/search?q=b&q=a", ("google", "Search", "a,b")), ("https://www.google.de/", ("google", "Search", None)),
    ("https://shop.example.co.uk/x", ("shop", "Shopping", None)), ("https://news.org/video", ("newsvideo", "Video", None)),
    ("https://news.org/text", ("news", "Referral", None)), ("https://new.org", ("new.org", "Unassigned", None)), ("", (None, None, None))])
def test_referrer(spark, referrer, want):
    df = traffic.referrer_category(urls(spark, referrer), "u", traffic.category_rules(spark, RULES))
    r = df.first()
    assert (r["ref_source"], r["ref_category"], r["ref_terms"]) == want


FIELDS = [f"traffic_source_{f}" for f in (*traffic.FIELDS, "category")] + [traffic.LATEST, traffic.LATEST_HOST]


@pytest.mark.parametrize("values,want", [
    ({}, "Direct"), ({"traffic_source_category": "search", "traffic_source_medium": "CPC"}, "Paid Search"),
    ({"traffic_source_category": "Search", "traffic_source_clid": "{}"}, "Paid Search"),
    ({"traffic_source_category": "Search"}, "Organic Search"), ({"traffic_source_medium": "sm"}, "Organic Social"),
    ({"traffic_source_category": "Shopping", "traffic_source_campaign": "big shopping day"}, "Paid Shopping"),
    ({"traffic_source_campaign": "eshop"}, "Organic Shopping"), ({"traffic_source_campaign": "workshop"}, "Unassigned"), ({"traffic_source_medium": "webpush"}, "Mobile Push Notifications"),
    ({traffic.LATEST: "https://a.org", traffic.LATEST_HOST: "a.org", "traffic_source_source": "a.org"}, "Referral"),
    ({traffic.LATEST_HOST: "x.internal.org", "traffic_source_source": "x"}, "Internal"),
    ({"traffic_source_source": "zzz"}, "Unassigned")])
def test_default_channels(spark, values, want):
    columns = {f: F.lit(values.get(f)).cast("string") for f in FIELDS}
    assert spark.range(1).select(traffic.channel_group(traffic.DEFAULT_CHANNELS, columns)).first()[0] == want


@pytest.mark.parametrize("op,value,want", [
    ("eq", "AB", True), ("not_eq", "ab", False), ("contain", "b", True), ("not_contain", "b", False), ("start_with", "a", True),
    ("not_start_with", "a", False), ("end_with", "a", False), ("not_end_with", "a", True), ("match", "a.", True), ("match", "a", False),
    ("not_match", "a", True), ("in", ["x", "AB"], True), ("not_in", ["x"], True)])
def test_rule_operators(spark, op, value, want):
    node = {"field": "f", "op": op, ("values" if isinstance(value, list) else "value"): value}
    rule = [{"channel": "hit", "condition": node}]
    got = spark.range(1).select(traffic.channel_group(json.dumps(rule), {"f": F.lit("Ab")})).first()[0]
    assert (got == "hit") == want


@pytest.mark.parametrize("node", [{}, {"field": "g", "op": "eq", "value": "x"}, {"field": "f", "op": "is", "value": "x"},
                                  {"field": "f", "op": "in"}, {"op::and": [], "op::or": []}])
def test_broken_rules(spark, node):
    with pytest.raises(ValueError):
        traffic.channel_group([{"channel": "c", "condition": node}], {"f": F.lit("x")})


def test_geo_fills_and_prefers_the_narrow_range(spark):
    ranges = spark.createDataFrame([(0, 2**32 - 1, "anywhere", "World", None), (167772160, 167772415, "ten", "World", "X")],
                                   "first bigint, last bigint, city string, continent string, country string")
    df = spark.createDataFrame([("10.0.0.9, 1.1.1.1", None), ("11.0.0.1", "kept"), ("fe80::1", "kept"), (None, "kept"), ("10.0.0.999", None)],
                               "ip string, geo_country string")
    got = {r["ip"]: (r["geo_city"], r["geo_country"]) for r in geo.geo_ip(df, ranges.where("city = 'ten' OR first = 0")).collect()}
    assert got["10.0.0.9, 1.1.1.1"] == ("ten", "X") and got["11.0.0.1"] == ("anywhere", "kept")
    assert got["fe80::1"] == (None, "kept") and got[None] == (None, "kept")


def test_device_categories(spark):
    names = ["Googlebot", "Spider", "iPhone", "Generic Smartphone", "iPad", "Kindle", "Mac", "PC", "Watch", None]
    got = spark.createDataFrame([(n,) for n in names], "d string").select(agent.category(F.col("d"))).collect()
    assert [r[0] for r in got] == ["Bot", "Bot", "Mobile", "Mobile", "Tablet", "Tablet", "PC", "PC", "Other", None]
