"""The driver's `events` table as raw uploads, in the shapes the clients send.

Ten neighbouring events make one upload, so uploads stay small whatever the table
holds. Some uploads and events are damaged on purpose; the rules are arithmetic on
the event number and are restated in the oracle.
"""

from __future__ import annotations

import base64
import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.adapt import _pick, raw_events

NOW_MSEC = 1_709_251_200_000  # 2024-03-01, after every event of the table
TEN_YEARS, HOURS_100 = 315_360_000_000, 360_000_000
AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.6045.66 Mobile Safari/537.36",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "Mozilla/5.0 (iPad; CPU OS 16_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.6 Safari/604.1",
]
PAGE = "https://www.shop.example.com/p/"
SEARCH = "https://www.google.com/search?q=red+shoes"
PARTNER = "https://blog.partner.org/post?x=1"
SOCIAL = "https://m.facebook.com/groups/1"
CATEGORY_RULES = [
    {"url": "google.com", "source": "google", "category": "Search", "params": ["q", "query"]},
    {"url": "bing.com", "source": "bing", "category": "Search", "params": ["q"]},
    {"url": "m.facebook.com", "source": "facebook", "category": "Social", "params": []},
    {"url": "youtube.com", "source": "youtube", "category": "Video", "params": ["search_query"]},
]


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain facts per event: n, u, k, kind, val, msec, name, upload number."""
    u, kind = F.col("user_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    web = u % 3 == 0
    name = (
        F.when(kind == "view", F.when(web, "_page_view").otherwise("_screen_view"))
        .when(kind == "click", F.when(k % 2 == 0, "_session_start").when(k % 3 == 0, "_profile_set").otherwise("_click"))
        .when(kind == "signup", "_first_open")
        .when(kind == "error", F.when(k % 4 == 0, "_app_start").when(k % 4 == 1, "_app_end").otherwise("_app_exception"))
        .otherwise(F.when(k % 5 == 1, "_user_engagement").otherwise("purchase")))
    return raw_events(spark, sf_dir).select(
        F.col("event_id").alias("n"), u.alias("u"), k.alias("k"), kind.alias("kind"), F.col("value").alias("val"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("msec"), name.alias("name"),
        F.floor(F.col("event_id") / 10).alias("b"))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def page_url() -> Column:
    k = F.col("k")
    tail = _pick(k % 8, ["", "?utm_source=newsletter&utm_medium=email&utm_campaign=spring%20sale", "?gclid=abc",
                         "?fbclid=xyz", "", "", "", "?a=1&b=two%20words&a=3"])
    return F.concat(_text(PAGE, k % 10), tail)


def event_struct() -> Column:
    n, u, k, msec = F.col("n"), F.col("u"), F.col("k"), F.col("msec")
    at = F.when(n % 109 == 0, msec + TEN_YEARS).when(n % 113 == 0, msec - HOURS_100).otherwise(msec)
    buy = F.col("kind") == "purchase"
    user = F.struct(
        F.when(u % 4 != 0, F.struct(_text("m", F.floor(u / 2)).alias("value"), msec.alias("set_timestamp"))).alias("_user_id"),
        F.struct((msec - 86_400_000).alias("value"), msec.alias("set_timestamp")).alias("_user_first_touch_timestamp"),
        F.struct((k % 2 == 0).alias("value"), msec.alias("set_timestamp")).alias("vip"),
        F.struct(_text("t", k % 3).alias("value"), msec.alias("set_timestamp")).alias("tier"),
    )
    item = lambda id_, more: F.struct(id_.alias("id"), _text("item ", k % 10).alias("name"), F.col("val").alias("price"),
                                      F.lit(2).alias("quantity"), _text("c", k % 3).alias("category"),
                                      F.lit("brand").alias("brand"), more.alias("color"))
    none = F.lit(None).cast("string")
    items = F.when(buy, F.array_compact(F.array(
        item(_text("i", k % 10), F.lit("red")), item(_text("i", k % 10 + 1), F.lit("blue")),
        item(_text("i", k % 10), F.lit("grey")), F.when(k % 4 == 0, item(none, F.lit("lost"))))))
    attributes = F.struct(
        _text("s", u, "-", F.floor(msec / 86_400_000)).alias("_session_id"), (msec - k * 1000).alias("_session_start_time_msec"),
        (k * 1000).cast("long").alias("_session_duration"), (1 + k % 3).cast("long").alias("_session_number"),
        _text("Title%20", k % 20).alias("_page_title"), page_url().alias("_page_url"),
        _pick(k % 8, [None, None, None, None, None, PAGE, PARTNER, SOCIAL]).alias("_page_referrer"),
        F.when(k % 8 == 4, F.lit(SEARCH)).alias("_latest_referrer"),
        F.round(F.col("val") * 100).cast("long").alias("_engagement_time_msec"), (k % 2 == 0).alias("_entrances"),
        _text("screen ", k % 20).alias("_screen_name"), _text("sid", k % 10).alias("_screen_id"),
        F.when(k % 7 == 0, F.lit("tss")).alias("_traffic_source_source"), _pick(u % 3, [None, "play", "appstore"])
        .alias("_app_install_channel"), _text("D", k % 4).alias("device_id"),
        _text("ch", k % 2).alias("_channel"), _text("c", k % 4).alias("color"), k.alias("size"), (k % 2 == 1).alias("flag"), F.struct(k.alias("a")).alias("obj"),
    )
    return F.struct(
        F.when(n % 101 != 0, _text("app", u % 2)).alias("app_id"), _text("u", u).alias("unique_id"),
        _text("d", u, "-", k % 3).alias("device_id"), F.col("name").alias("event_type"),
        F.when(n % 103 != 0, _text("e", n)).alias("event_id"), F.when(n % 107 != 0, at).alias("timestamp"),
        _pick(u % 3, ["Web", "Android", "iOS"]).alias("platform"), _text("v", u % 6).alias("os_version"),
        F.lit("maker").alias("make"), F.lit("brandy").alias("brand"), _text("model", u % 5).alias("model"),
        F.lit("WIFI").alias("network_type"), F.lit(1920).alias("screen_height"), F.lit(1080).alias("screen_width"),
        F.lit(28_800_000).alias("zone_offset"), F.lit("en_US").alias("locale"), F.lit("en").alias("system_language"),
        _text("1.", k % 4).alias("app_version"), F.lit("com.example.app").alias("app_package_name"),
        F.when(buy, F.col("val")).alias("event_value"), F.lit("2.0").alias("sdk_version"), F.lit("js").alias("sdk_name"),
        k.alias("level"), F.lit("top").alias("color"), user.alias("user"), attributes.alias("attributes"),
        items.alias("items"),
    )


def _gzip_udf():
    """Nested so that the code travels with the job."""
    def pack(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode())

    return F.pandas_udf(pack, T.StringType())


gzip_base64 = _gzip_udf()


def _uploads(rows: DataFrame, payload: Column) -> DataFrame:
    """Groups of at most ten events with the facts of the request around them."""
    b, ingest = F.col("b"), F.col("ingest_time")
    packed = rows.groupBy("b").agg(
        F.max("msec").alias("_last"),
        F.transform(F.array_sort(F.collect_list(F.struct("n", payload.alias("e")))), lambda x: x["e"]).alias("list"))
    return packed.select(
        "b", _text("r", b).alias("rid"), (F.col("_last") + 5000).alias("ingest_time"), "list",
    ).select(
        "*", _text("/collect?event_bundle_sequence_id=", b, "&upload_timestamp=", ingest - (b % 3) * 700_000).alias("uri"),
        _text("10.", b % 25, ".1.", b % 200).alias("ip"), _pick(b % 5, AGENTS).alias("ua"), F.lit("POST").alias("m"),
        F.lit("http").alias("source_type"), F.lit("/collect").alias("path"), _text("app", b % 2).alias("appId"),
        F.lit("gzip").alias("compression"), F.lit("Web").alias("platform"),
        F.date_format(F.timestamp_millis(ingest), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("date"),
        F.lit(None).cast("string").alias("client_timestamp"), F.lit(None).cast("string").alias("server_ingest_time"),
        F.date_format(F.timestamp_millis(ingest), "HH").alias("hour"),
    )


def sdk_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads of the own SDK: plain and packed ones, a few damaged."""
    rows = _uploads(numbered(spark, sf_dir), event_struct()).withColumn("text", F.to_json("list"))
    b = F.col("b")
    data = (
        F.when(b % 50 == 7, F.lit(None).cast("string")).when(b % 50 == 13, "not base64!!").when(b % 50 == 19, "[{broken")
        .when(b % 2 == 1, gzip_base64(F.when(b % 2 == 1, F.col("text")))).otherwise(F.col("text")))
    return rows.withColumn("data", data).drop("list", "text", "b")


def web_tag_struct() -> Column:
    u, k, msec = F.col("u"), F.col("k"), F.col("msec")
    return F.struct(
        F.when(F.col("kind") == "view", "page_view").when(F.col("kind") == "signup", "login")
        .when(F.col("kind") == "click", "click").when(F.col("kind") == "purchase", "purchase").alias("event_name"),
        _text("u", u).alias("client_id"), F.when(u % 4 != 0, _text("m", F.floor(u / 2))).alias("user_id"),
        _text("s", u).alias("ga_session_id"), F.when(k % 2 == 0, k).alias("ga_session_number"),
        page_url().alias("page_location"), F.when(k % 3 == 0, F.lit(PARTNER)).alias("page_referrer"),
        _text("Title%20", k % 20).alias("page_title"), F.lit("en").alias("language"), F.lit("1024x768").alias("screen_resolution"),
        _text("10.", u % 25, ".0.1").alias("ip_override"), F.lit(AGENTS[0]).alias("user_agent"),
        (k * 10).alias("engagement_time_msec"),
        F.struct(F.array(F.struct(F.lit("Chromium").alias("brand"), F.lit("120").alias("version"))).alias("brands"),
                 F.lit(False).alias("mobile"), F.when(u % 2 == 0, "mac OS").alias("platform")).alias("client_hints"),
        F.struct(F.when(k % 10 == 0, "1").alias("fv"), F.when(k % 5 == 0, "1").alias("ss")).alias("x-ga-system_properties"),
        F.struct(_text("NATION_", u % 25).alias("uc"), (msec - 100).alias("request_start_time_ms")).alias("x-sst-system_properties"),
        F.when(F.col("kind") == "purchase", F.lit("EUR")).alias("currency"),
        F.when(F.col("kind") == "purchase", F.col("val")).alias("value"),
        F.when(F.col("kind") == "purchase", F.array(
            F.struct(_text("i", k % 10).alias("item_id"), F.lit("thing").alias("item_name"), F.col("val").alias("price")),
            F.struct(F.lit(None).cast("string").alias("item_id"), F.lit("lost").alias("item_name"), F.col("val").alias("price"))))
        .alias("items"),
        _text("x", k % 4).alias("theme"),
    )


def web_tag_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _uploads(numbered(spark, sf_dir), web_tag_struct())
    return rows.withColumn("data", F.to_json("list")).drop("list", "b")


def alt_sdk_struct() -> Column:
    u, k, msec = F.col("u"), F.col("k"), F.col("msec")
    return F.struct(
        msec.alias("time"), _text("u", u).alias("distinct_id"), _text("a", u).alias("anonymous_id"),
        F.struct(F.when(u % 4 != 0, _text("m", F.floor(u / 2))).alias("$identity_login_id")).alias("identities"),
        F.when(F.col("kind") == "view", "page_view").when(F.col("kind") == "click", "click").otherwise(F.col("kind")).alias("event"),
        F.struct(F.lit("js").alias("$lib"), F.lit("1.26").alias("$lib_version"), _text("1.", k % 4).alias("$app_version")).alias("lib"),
        F.struct(page_url().alias("$url"), _text("Title%20", k % 20).alias("$title"), F.when(u % 3 != 0, "Android").alias("$os"),
                 (k % 10 == 0).alias("$is_first_time"), (k % 2 == 0).alias("$wifi"), (k * 5).alias("$event_duration"),
                 _text("city", u % 7).alias("$city"), _text("x", k % 4).alias("theme")).alias("properties"),
    )


def alt_sdk_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form text around a packed list; every third upload is plain JSON."""
    rows = _uploads(numbered(spark, sf_dir), alt_sdk_struct()).withColumn("text", F.to_json("list"))
    form = F.concat(F.lit("crc=1&gzip=1&data_list="), F.url_encode(gzip_base64(F.col("text"))))
    return rows.withColumn("data", F.when(F.col("b") % 3 == 0, F.col("text")).otherwise(form)).drop("list", "text", "b")
