"""Cleaning, parsing, enrichment and table extraction: query and oracle per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventloom import uploads as up
from eventloom.adapt import raw_events
from eventloom.catalog import base as b
from eventloom.catalog.base import clock, with_base
from eventloom.functions import text, url
from eventloom.operators import (
    agent, altsdk, backfill, clean, dedupe, fields, geo, legacy, sessions, tables, traffic, view, webtag,
)
from eventloom.operators.parse import parse_events, time_shift
from eventloom.session import scratch, staged

QUERIES: dict[str, b.Query] = {}
ORACLES: dict[str, str] = {}
APPS = ["app0", "app1"]
AT = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def add(key: str, fn: b.Query, sql: str | None = None) -> None:
    QUERIES[key] = b.query(fn)
    if sql is not None:
        ORACLES[key] = sql


# What the uploads hold, computed from the events alone.
RAW = f"""
r0 AS (SELECT event_id AS n, user_id AS u, event_type AS kind, value AS val, epoch_us(ts) // 1000 AS ms,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id // 10 AS b FROM events),
r1 AS (SELECT *, CASE WHEN kind = 'view' THEN CASE WHEN u % 3 = 0 THEN '_page_view' ELSE '_screen_view' END
    WHEN kind = 'click' THEN CASE WHEN k % 2 = 0 THEN '_session_start' WHEN k % 3 = 0 THEN '_profile_set' ELSE '_click' END
    WHEN kind = 'signup' THEN '_first_open'
    WHEN kind = 'error' THEN CASE k % 4 WHEN 0 THEN '_app_start' WHEN 1 THEN '_app_end' ELSE '_app_exception' END
    ELSE CASE WHEN k % 5 = 1 THEN '_user_engagement' ELSE 'purchase' END END AS name,
  CASE WHEN n % 109 = 0 THEN ms + {up.TEN_YEARS} WHEN n % 113 = 0 THEN ms - {up.HOURS_100} ELSE ms END AS et,
  max(ms) OVER (PARTITION BY n // 10) + 5000 AS ingest, row_number() OVER (PARTITION BY n // 10 ORDER BY n) - 1 AS pos
  FROM r0),
ent AS (SELECT *, b % 50 NOT IN (7, 13, 19) AS fine FROM r1),
ok AS (SELECT * FROM ent WHERE fine AND n % 101 <> 0 AND n % 103 <> 0 AND n % 107 <> 0),
fr AS (SELECT *, CASE WHEN et > {up.NOW_MSEC} THEN ingest ELSE et END AS em,
    CASE WHEN et > {up.NOW_MSEC} THEN ingest - et ELSE 0 END AS diff FROM ok
  WHERE name IN ('_first_open', '_profile_set')
  OR (et <= {up.NOW_MSEC} AND ingest - et <= 72 * 3600000)),
pe AS (SELECT *, 'e' || n AS event_id, 'u' || u AS user_pseudo_id, 'app' || (u % 2) AS app_id, epoch_ms(em) AS event_timestamp,
    CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END AS user_id, 's' || u || '-' || (ms // 86400000) AS session_id,
    {b.pick('u % 3', ['Web', 'Android', 'iOS'])} AS platform FROM fr),"""


def sql(body: str, *extra: str) -> str:
    return "WITH " + (RAW + "".join(extra)).strip().rstrip(",") + "\n" + body


def entries(s, d):
    return clean.parse_uploads(up.sdk_uploads(s, d))


def good(s, d):
    return clean.clean(up.sdk_uploads(s, d), APPS, up.NOW_MSEC)[0]


def parsed(s, d):
    return parse_events(time_shift(good(s, d), up.NOW_MSEC))


def stored(s, d, *columns):
    """Parsed events written once, as the batch run does before steps that read them twice; of the named columns, if any are.

    What is written cannot be pruned by what reads it, and writing all columns takes most of the time of a query that needs few.
    """
    rows = parsed(s, d)
    return staged(rows.select(*columns) if columns else rows, "parsed")


# ------------------------------------------------------------------- cleaning

add("decode_payload", lambda s, d: up.sdk_uploads(s, d).select("rid", clean.decode_payload(F.col("data")).alias("p")).select(
    "rid", F.col("p").startswith('["error').alias("failed"), F.json_array_length("p").alias("entries")), sql("""
SELECT 'r' || b AS rid, b % 50 IN (7, 13, 19) AS failed, CASE WHEN b % 50 IN (7, 13, 19) THEN 1 ELSE count(*) END AS entries
FROM r1 GROUP BY b"""))
add("explode_events", lambda s, d: clean.explode_events(up.sdk_uploads(s, d)).select(
    "rid", "position", F.get_json_object("data", "$.event_id").alias("event_id")),
    sql("""SELECT 'r' || b AS rid, pos AS position, CASE WHEN n % 103 <> 0 THEN 'e' || n END AS event_id FROM ent WHERE fine
UNION ALL SELECT DISTINCT 'r' || b, 0, NULL FROM ent WHERE NOT fine"""))
add("split_corrupt", lambda s, d: entries(s, d).groupBy(
    F.coalesce(clean.reject_reason(), F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n")), sql("""
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN n % 103 = 0 THEN 'event_id' WHEN n % 101 = 0 THEN 'app_id'
  WHEN n % 107 = 0 THEN 'timestamp' ELSE 'ok' END AS reason FROM ent WHERE fine
  UNION ALL SELECT 'corrupt' FROM (SELECT DISTINCT b FROM ent WHERE NOT fine)) GROUP BY reason"""))
add("filter_freshness", lambda s, d: clean.fresh(clean.split_corrupt(entries(s, d))[0], up.NOW_MSEC)
    .select("e.event_id", "e.event_type"), sql("SELECT event_id, name AS event_type FROM pe"))
add("filter_apps", lambda s, d: clean.filter_apps(clean.split_corrupt(entries(s, d))[0], ["app1"])
    .select("e.event_id", "e.app_id"), sql("SELECT 'e' || n AS event_id, 'app' || (u % 2) AS app_id FROM ok WHERE u % 2 = 1"))

# -------------------------------------------------------------------- parsing

add("parse_sdk", lambda s, d: parsed(s, d).select(
    "event_id", "event_name", "event_timestamp", "event_time_msec", "event_value", "event_value_currency",
    "event_bundle_sequence_id", "ingest_time_msec", "device_mobile_model_name", "device_operating_system",
    "device_time_zone_offset_seconds", "app_version", "app_id", "platform", "screen_view_screen_name", "page_view_page_title",
    "user_pseudo_id", "user_id", "session_id", "session_number", "session_duration", "session_start_time_msec",
    "page_view_entrances", "app_install_source", "user_first_touch_time_msec"), sql(f"""
SELECT event_id, name AS event_name, {clock('event_timestamp')} AS event_timestamp, em AS event_time_msec,
  CASE WHEN kind = 'purchase' THEN val END AS event_value, CASE WHEN kind = 'purchase' THEN 'USD' END AS event_value_currency,
  b AS event_bundle_sequence_id, ingest AS ingest_time_msec, 'model' || (u % 5) AS device_mobile_model_name,
  CASE WHEN u % 3 <> 0 THEN platform END AS device_operating_system, 28800 AS device_time_zone_offset_seconds,
  '1.' || (k % 4) AS app_version, app_id, platform, 'screen ' || (k % 20) AS screen_view_screen_name,
  'Title ' || (k % 20) AS page_view_page_title, user_pseudo_id, user_id, session_id, CAST(1 + k % 3 AS BIGINT) AS session_number,
  CAST(k * 1000 AS BIGINT) AS session_duration, ms - k * 1000 + diff AS session_start_time_msec, k % 2 = 0 AS page_view_entrances,
  {b.pick('u % 3', [None, 'play', 'appstore'])} AS app_install_source,
  ms - 86400000 + diff AS user_first_touch_time_msec FROM pe"""))
add("parse_conditional", lambda s, d: parsed(s, d).select(
    "event_id", "user_engagement_time_msec", "scroll_engagement_time_msec", "page_view_engagement_time_msec",
    "screen_view_engagement_time_msec", "app_start_is_first_time"), sql("""
SELECT event_id, CASE WHEN name = '_user_engagement' THEN CAST(round(val * 100) AS BIGINT) END AS user_engagement_time_msec,
  CAST(NULL AS BIGINT) AS scroll_engagement_time_msec,
  CASE WHEN name = '_page_view' THEN CAST(round(val * 100) AS BIGINT) END AS page_view_engagement_time_msec,
  CASE WHEN name = '_screen_view' THEN CAST(round(val * 100) AS BIGINT) END AS screen_view_engagement_time_msec,
  CAST(NULL AS BOOLEAN) AS app_start_is_first_time FROM pe"""))
add("custom_params", lambda s, d: parsed(s, d).select("event_id", F.explode("custom_parameters").alias("key", "v")).select(
    "event_id", "key", "v.value", "v.type"), sql("""
SELECT event_id, key, value, type FROM pe, LATERAL (VALUES ('level', CAST(k AS VARCHAR), 'number'), ('color', 'c' || (k % 4), 'string'),
  ('size', CAST(k AS VARCHAR), 'number'), ('flag', CASE WHEN k % 2 = 1 THEN 'true' ELSE 'false' END, 'boolean'),
  ('obj', '{"a":' || k || '}', 'object'), ('device_id', 'D' || (k % 4), 'string'), ('_channel', 'ch' || (k % 2), 'string')) t(key, value, type)"""))
add("time_shift", lambda s, d: time_shift(clean.split_corrupt(entries(s, d))[0], up.NOW_MSEC, True).select(
    F.col("e.event_id"), "event_msec", "time_diff", "shifted"), sql(f"""
SELECT 'e' || n AS event_id, et + d2 AS event_msec, d2 AS time_diff, moved AS shifted FROM (
  SELECT *, CASE WHEN et + d1 > {up.NOW_MSEC} THEN ingest - et ELSE d1 END AS d2, d1 <> 0 OR et > {up.NOW_MSEC} AS moved
  FROM (SELECT *, CASE WHEN et > {up.NOW_MSEC} OR (b % 3) * 700000 > 600000 THEN (b % 3) * 700000 ELSE 0 END AS d1 FROM ok))"""))

_Q8 = b.pick('k % 8', ["", "?utm_source=newsletter&utm_medium=email&utm_campaign=spring%20sale", "?gclid=abc", "?fbclid=xyz",
                       "", "", "", "?a=1&b=two%20words&a=3"])
add("url_parts", lambda s, d: parsed(s, d).select(
    "event_id", "page_view_page_url", "page_view_page_url_path", "page_view_hostname", "page_view_latest_referrer_host",
    F.col("page_view_page_url_query_parameters")["a"].alias("qa"), F.col("page_view_page_url_query_parameters")["b"].alias("qb"),
    "page_view_latest_referrer"), sql(f"""
SELECT event_id, replace('{up.PAGE}' || (k % 10) || {_Q8}, '%20', ' ') AS page_view_page_url, '/p/' || (k % 10) AS page_view_page_url_path,
  'www.shop.example.com' AS page_view_hostname, CASE WHEN k % 8 = 4 THEN 'www.google.com' END AS page_view_latest_referrer_host,
  CASE WHEN k % 8 = 7 THEN '1,3' END AS qa, CASE WHEN k % 8 = 7 THEN 'two words' END AS qb,
  CASE WHEN k % 8 = 4 THEN replace('{up.SEARCH}', '+', ' ') END AS page_view_latest_referrer FROM pe"""))
add("url_parts_pages", lambda s, d: s.read.parquet(f"{d}/pages.parquet").select(
    "page_id", url.host(F.col("url")).alias("host"), url.path(F.col("url")).alias("path"),
    url.params(url.pairs(url.query(F.col("url"))))["page"].alias("page")), r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
  regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
  nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages""")
add("utm_extract", lambda s, d: parsed(s, d).select("event_id", traffic.utm(F.col("raw_page_url")).alias("t")).select(
    "event_id", "t.*"), sql("""
SELECT event_id, CASE k % 8 WHEN 1 THEN 'newsletter' WHEN 2 THEN 'Google' WHEN 3 THEN 'fbclid' END AS source,
  CASE k % 8 WHEN 1 THEN 'email' WHEN 2 THEN '(CPC)' WHEN 3 THEN '(CPC)' END AS medium,
  CASE k % 8 WHEN 1 THEN 'spring sale' END AS campaign, CAST(NULL AS VARCHAR) AS content, CAST(NULL AS VARCHAR) AS term,
  CAST(NULL AS VARCHAR) AS campaign_id, CAST(NULL AS VARCHAR) AS clid_platform,
  CASE k % 8 WHEN 2 THEN '{"type":"gclid","value":"abc"}' WHEN 3 THEN '{"type":"fbclid","value":"xyz"}' END AS clid FROM pe"""))
add("utm_pages", lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", traffic.utm(F.col("url")).alias("t")).select(
    "page_id", "t.source"), """
SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source FROM pages""")
add("referrer_category", lambda s, d: traffic.referrer_category(
    stored(s, d).withColumn("ref", F.coalesce("raw_latest_referrer", "raw_page_referrer")), "ref",
    traffic.category_rules(s, up.CATEGORY_RULES)).select("event_id", "ref_source", "ref_category", "ref_terms"), sql("""
SELECT event_id, CASE k % 8 WHEN 4 THEN 'google' WHEN 5 THEN 'www.shop.example.com' WHEN 6 THEN 'blog.partner.org'
    WHEN 7 THEN 'facebook' END AS ref_source,
  CASE k % 8 WHEN 4 THEN 'Search' WHEN 5 THEN 'Unassigned' WHEN 6 THEN 'Unassigned' WHEN 7 THEN 'Social' END AS ref_category,
  CASE k % 8 WHEN 4 THEN 'red shoes' END AS ref_terms FROM pe"""))


def _channel_inputs(s, d):
    fields_ = {f"traffic_source_{f}": F.col(f"traffic_source_{f}") for f in traffic.FIELDS + ["category"]}
    fields_[traffic.LATEST] = F.lit(None).cast("string")
    fields_[traffic.LATEST_HOST] = F.lit(None).cast("string")
    return b.events(s, d).select("event_id", traffic.channel_group(traffic.DEFAULT_CHANNELS, fields_).alias("channel"))


# Sources of the event view: 'Direct' is a category of its own there.
add("channel_group", _channel_inputs, with_base("""
SELECT event_id, CASE
  WHEN coalesce(traffic_source_category, traffic_source_source, traffic_source_medium, traffic_source_campaign,
    traffic_source_clid_platform) IS NULL THEN 'Direct'
  WHEN traffic_source_category = 'Search' AND traffic_source_medium = 'cpc' THEN 'Paid Search'
  WHEN traffic_source_category = 'Search' AND coalesce(traffic_source_medium, 'organic') = 'organic' THEN 'Organic Search'
  WHEN traffic_source_category = 'Social' AND traffic_source_medium = 'cpc' THEN 'Paid Social'
  WHEN traffic_source_category = 'Social' THEN 'Organic Social'
  WHEN traffic_source_category IS NULL AND traffic_source_medium = 'cpc' THEN 'Paid Other'
  ELSE 'Unassigned' END AS channel FROM ev"""))
_SOURCE = [f"traffic_source_{f}" for f in (*traffic.FIELDS, "channel_group", "category")]
add("traffic_source", lambda s, d: traffic.traffic_source(stored(
    s, d, "event_id", "raw_page_url", "raw_page_referrer", "raw_latest_referrer", "page_view_latest_referrer_host", *_SOURCE),
    up.CATEGORY_RULES).select("event_id", *_SOURCE), sql("""
SELECT event_id,
  CASE WHEN k % 7 = 0 THEN 'tss' ELSE CASE k % 8 WHEN 1 THEN 'newsletter' WHEN 2 THEN 'Google' WHEN 3 THEN 'fbclid'
    WHEN 4 THEN 'google' WHEN 6 THEN 'blog.partner.org' WHEN 7 THEN 'facebook' ELSE 'Direct' END END AS traffic_source_source,
  CASE WHEN k % 7 <> 0 THEN CASE k % 8 WHEN 1 THEN 'email' WHEN 2 THEN '(CPC)' WHEN 3 THEN '(CPC)' WHEN 4 THEN '(Organic)'
    WHEN 6 THEN '(Referral)' WHEN 7 THEN '(Referral)' ELSE 'None' END END AS traffic_source_medium,
  CASE WHEN k % 7 <> 0 THEN CASE k % 8 WHEN 1 THEN 'spring sale' WHEN 0 THEN 'Direct' WHEN 5 THEN 'Direct' END END AS traffic_source_campaign,
  CAST(NULL AS VARCHAR) AS traffic_source_content,
  CASE WHEN k % 7 <> 0 AND k % 8 = 4 THEN 'red shoes' END AS traffic_source_term,
  CAST(NULL AS VARCHAR) AS traffic_source_campaign_id, CAST(NULL AS VARCHAR) AS traffic_source_clid_platform,
  CASE WHEN k % 7 <> 0 THEN CASE k % 8 WHEN 2 THEN '{"type":"gclid","value":"abc"}' WHEN 3 THEN '{"type":"fbclid","value":"xyz"}' END END
    AS traffic_source_clid,
  CASE WHEN k % 8 = 4 THEN 'Organic Search' WHEN k % 8 = 6 THEN 'Referral' WHEN k % 8 = 7 THEN 'Organic Social'
    WHEN k % 7 = 0 THEN 'Unassigned' WHEN k % 8 = 1 THEN 'Email' WHEN k % 8 IN (2, 3) THEN 'Paid Other'
    WHEN k % 8 = 5 THEN 'Internal' ELSE 'Direct' END AS traffic_source_channel_group,
  CASE WHEN k % 8 = 4 THEN 'Search' WHEN k % 8 = 7 THEN 'Social' WHEN k % 8 = 6 THEN 'Unassigned' WHEN k % 7 = 0 THEN 'Unassigned'
    WHEN k % 8 IN (1, 2, 3) THEN 'Unassigned' ELSE 'Direct' END AS traffic_source_category FROM pe"""))

# ----------------------------------------------------------------- enrichment


def nation_ranges(s, d):
    """One /16 network per nation, and a narrower one inside it."""
    n = F.col("n_nationkey").cast("long")
    net = F.lit(10 * 16_777_216) + n * 65_536
    rows = s.read.parquet(f"{d}/nation.parquet")
    wide = rows.select(net.alias("first"), (net + 65_535).alias("last"), F.lit(None).cast("string").alias("city"),
                       F.lit("World").alias("continent"), F.col("n_name").alias("country"))
    narrow = rows.select((net + 256).alias("first"), (net + 355).alias("last"), F.concat(F.lit("city"), n).alias("city"),
                         F.lit("World").alias("continent"), F.col("n_name").alias("country"))
    return wide.unionByName(narrow)


add("geo_ip", lambda s, d: geo.geo_ip(stored(s, d), nation_ranges(s, d)).select("event_id", "ip", *geo.GEO), sql("""
SELECT event_id, '10.' || (b % 25) || '.1.' || (b % 200) AS ip, CASE WHEN b % 200 < 100 THEN 'city' || (b % 25) END AS geo_city,
  'World' AS geo_continent, n_name AS geo_country FROM pe JOIN nation ON n_nationkey = b % 25"""))
_UA = """CASE b % 5 WHEN 3 THEN 'Other' WHEN 0 THEN 'Chrome' WHEN 2 THEN 'Chrome' ELSE 'Safari' END AS device_ua_browser,
  CASE b % 5 WHEN 0 THEN '120.0.0' WHEN 1 THEN '17.1' WHEN 2 THEN '119.0.6045' WHEN 4 THEN '16.6' END AS device_ua_browser_version,
  CASE b % 5 WHEN 0 THEN 'Windows' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Android' WHEN 4 THEN 'iOS' ELSE 'Other' END AS device_ua_os,
  CASE b % 5 WHEN 0 THEN '10.0' WHEN 1 THEN '17.1.2' WHEN 2 THEN '14' WHEN 4 THEN '16.6' END AS device_ua_os_version,
  CASE b % 5 WHEN 0 THEN 'PC' WHEN 1 THEN 'iPhone' WHEN 2 THEN 'Generic Smartphone' WHEN 3 THEN 'Spider' ELSE 'iPad' END AS device_ua_device,
  CASE b % 5 WHEN 0 THEN 'PC' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Mobile' WHEN 3 THEN 'Bot' ELSE 'Tablet' END AS device_ua_device_category"""
_UA_COLUMNS = ["device_ua_browser", "device_ua_browser_version", "device_ua_os", "device_ua_os_version",
               "device_ua_device", "device_ua_device_category"]
add("parse_ua", lambda s, d: agent.parse_ua(stored(s, d)).select("event_id", *_UA_COLUMNS), sql(f"SELECT event_id, {_UA} FROM pe"))


def _agent_rules(s):
    """200 apps that name themselves, before the general families."""
    apps = s.range(200).select(F.lit("browser").alias("kind"), F.lit(1).alias("priority"), F.concat(F.lit("app"), "id").alias("token"),
                               F.concat(F.lit("App"), "id", F.lit("/")).alias("pattern"), F.concat(F.lit("App "), "id").alias("name"),
                               F.concat(F.lit("App"), "id", F.lit(r"/([\d.]+)")).alias("version"))
    general = [("browser", 20, "chrome", None, "Chrome", r"Chrome/(\d+(?:\.\d+){0,2})"), ("browser", 30, "safari", "Version/", "Safari", r"Version/([\d.]+)"),
               ("browser", 25, "mozilla", "Gecko/20", "Firefox", None), ("os", 10, "windows", None, "Windows", r"Windows NT ([\d.]+)"),
               ("os", 20, "os", "(?:iPhone|iPad).* OS ", "iOS", r" OS ([\d_]+)"), ("os", 10, "android", None, "Android", r"Android ([\d.]+)"),
               ("os", 30, "linux", None, "Linux", None), ("device", 10, "googlebot", None, "Spider", None), ("device", 20, "iphone", None, "iPhone", None),
               ("device", 20, "ipad", None, "iPad", None), ("device", 30, "android", "Mobile", "Generic Smartphone", None), ("device", 30, "windows", None, "PC", None)]
    return apps.unionByName(s.createDataFrame(general, agent.RULES))


def _ua_rules(s, d):
    rows = stored(s, d)
    n = F.regexp_extract("event_id", r"(\d+)", 1).cast("long")
    named = rows.withColumn("ua", F.when(n % 2 == 0, F.concat("ua", F.lit(" App"), n % 200, F.lit("/"), n % 7, F.lit("."), n % 3)).otherwise(F.col("ua")))
    return agent.parse_ua(named, rules=_agent_rules(s)).select("event_id", *_UA_COLUMNS)


add("parse_ua_rules", _ua_rules, sql(f"""
SELECT event_id, CASE WHEN n % 2 = 0 THEN 'App ' || (n % 200) ELSE device_ua_browser END AS device_ua_browser,
  CASE WHEN n % 2 = 0 THEN (n % 7) || '.' || (n % 3) ELSE device_ua_browser_version END AS device_ua_browser_version,
  device_ua_os, device_ua_os_version, device_ua_device, device_ua_device_category
FROM (SELECT event_id, CAST(regexp_extract(event_id, '([0-9]+)', 1) AS BIGINT) AS n, {_UA} FROM pe)"""))
add("filter_bots", lambda s, d: clean.drop_bots(agent.parse_ua(stored(s, d))).select("event_id", "device_ua_device_category"),
    sql(f"SELECT event_id, device_ua_device_category FROM (SELECT event_id, {_UA} FROM pe WHERE b % 5 <> 3)"))

# --------------------------------------------------------------- field filters

_SOME = ["event_id", "event_name", "event_timestamp", "app_id", "user_pseudo_id", "platform", "geo_country", "app_version"]
_PLAIN = f"event_id, event_name, {clock('event_timestamp')} AS event_timestamp, app_id, user_pseudo_id, platform"
add("field_whitelist", lambda s, d: fields.field_filter(
    b.events(s, d), fields.FieldRule("whitelist", ("geo_country", "missing"))),
    with_base(f"SELECT {_PLAIN}, geo_country FROM ev"))
add("field_blacklist", lambda s, d: fields.field_filter(
    b.events(s, d).select(*_SOME), fields.FieldRule("blacklist", ("geo_country", "event_id"))),
    with_base(f"SELECT {_PLAIN}, app_version FROM ev"))
add("field_rules", lambda s, d: fields.apply_field_rules(b.events(s, d).select(*_SOME), fields.effective_rules(
    APPS, {"app1": fields.FieldRule("whitelist", ("geo_country",))}, fields.FieldRule("blacklist", ("geo_country",))), APPS),
    with_base(f"""SELECT {_PLAIN}, CASE WHEN app_id = 'app1' THEN geo_country END AS geo_country,
  CASE WHEN app_id = 'app0' THEN app_version END AS app_version FROM ev"""))

add("field_rules_one_app", lambda s, d: fields.apply_field_rules(
    b.events(s, d).select(*_SOME), {"app1": fields.FieldRule("whitelist", ("geo_country",))}, APPS),
    with_base(f"SELECT {_PLAIN}, geo_country, CASE WHEN app_id = 'app0' THEN app_version END AS app_version FROM ev"))

# --------------------------------------------------------------------- tables

add("extract_events", lambda s, d: tables.extract_events(parsed(s, d), "job-1", AT).select(
    "event_id", "event_name", "event_timestamp", "created_time", F.col("process_info")["process_job_id"].alias("job"),
    F.col("process_info")["rid"].alias("rid"), F.col("process_info")["event_timestamp_adjusted"].alias("adjusted")), sql(f"""
SELECT event_id, name AS event_name, {clock('event_timestamp')} AS event_timestamp, '2024-03-01 00:00:00.000000' AS created_time,
  'job-1' AS job, 'r' || b AS rid, CASE WHEN et > {up.NOW_MSEC} THEN 'true' END AS adjusted FROM pe"""))
add("extract_items", lambda s, d: tables.extract_items(parsed(s, d)).select(
    "event_id", "user_pseudo_id", "item_id", "name", "price", "quantity", "category", "brand",
    F.col("custom_parameters")["color"]["value"].alias("color")), sql("""
SELECT event_id, user_pseudo_id, 'i' || (k % 10 + j) AS item_id, 'item ' || (k % 10) AS name, val AS price, CAST(2 AS DOUBLE) AS quantity,
  'c' || (k % 3) AS category, 'brand' AS brand, CASE j WHEN 0 THEN 'red' ELSE 'blue' END AS color
FROM pe, (VALUES (0), (1)) t(j) WHERE kind = 'purchase'"""))
add("extract_sessions", lambda s, d: sessions.extract_sessions(parsed(s, d)).select(
    "app_id", "user_pseudo_id", "session_id", "event_timestamp", "session_number", "session_source",
    F.col("process_info")["event_name"].alias("from_event")), sql(f"""
SELECT app_id, user_pseudo_id, session_id, {clock('event_timestamp')} AS event_timestamp, CAST(1 + k % 3 AS BIGINT) AS session_number,
  CASE WHEN k % 7 = 0 THEN 'tss' END AS session_source, name AS from_event FROM pe
WHERE name IN ('_session_start','_page_view','_user_engagement','_screen_view','_app_end')
QUALIFY row_number() OVER (PARTITION BY app_id, user_pseudo_id, session_id
  ORDER BY CASE WHEN k % 7 = 0 THEN 0 ELSE 1 END, em, event_id) = 1"""))
_USERS = f"""
fo AS (SELECT * FROM pe WHERE name IN ('_first_open','_first_visit','_session_start','_screen_view')
  QUALIFY row_number() OVER (PARTITION BY app_id, user_pseudo_id ORDER BY em, event_id) = 1),
la AS (SELECT * FROM pe WHERE name = '_profile_set'
  QUALIFY row_number() OVER (PARTITION BY app_id, user_pseudo_id ORDER BY em DESC, event_id DESC) = 1),
al AS (SELECT app_id, user_pseudo_id, max(user_id) AS user_id, max(em) AS last FROM pe GROUP BY ALL),
uo AS (SELECT al.app_id, al.user_pseudo_id, al.user_id, {clock('epoch_ms(al.last)')} AS event_timestamp,
  fo.ms - 86400000 + fo.diff AS first_touch_time_msec, CASE WHEN fo.k % 7 = 0 THEN 'tss' END AS first_traffic_source,
  {b.pick('fo.u % 3', [None, 'play', 'appstore'])} AS first_app_install_source, 't' || (la.k % 3) AS tier,
  CASE WHEN la.k % 2 = 0 THEN 'true' WHEN la.k IS NOT NULL THEN 'false' END AS vip, fo.name AS first_event, la.ms AS set_msec
  FROM al LEFT JOIN fo USING (app_id, user_pseudo_id) LEFT JOIN la USING (app_id, user_pseudo_id)),"""


def _user_columns(df):
    p = F.col("user_properties")
    return df.select("app_id", "user_pseudo_id", "user_id", "event_timestamp", "first_touch_time_msec",
                     "first_traffic_source", "first_app_install_source", p["tier"]["value"].alias("tier"),
                     p["vip"]["value"].alias("vip"), F.col("process_info")["first_event_name"].alias("first_event"),
                     p["tier"]["set_time_msec"].alias("set_msec"))


add("extract_users", lambda s, d: _user_columns(tables.extract_users(parsed(s, d))), sql("SELECT * FROM uo", _USERS))


def _user_state(s, d):
    """The second half of the table merged into the history of the first half."""
    rows = staged(tables.user_rows(parsed(s, d)), "user_rows")  # read three times below, parsed once
    cut = F.col("event_timestamp") < F.lit("2024-01-15").cast("timestamp")
    return _user_columns(tables.merge_user_state(
        tables.partial_users(rows.where(~cut)), tables.partial_users(rows.where(cut))))


add("user_state", _user_state, sql("""SELECT uo.* FROM uo WHERE (app_id, user_pseudo_id) IN (
  SELECT (app_id, user_pseudo_id) FROM pe WHERE event_timestamp >= TIMESTAMP '2024-01-15')""", _USERS))

# ---------------------------------------------------------------- third party

_WT = """
wt AS (SELECT *, CASE kind WHEN 'view' THEN '_page_view' WHEN 'signup' THEN '_profile_set' WHEN 'click' THEN '_click'
    WHEN 'purchase' THEN 'purchase' END AS nm,
  'r' || b || '-' || pos || '-s' || u || '-' || CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE 'x' END AS eid
  FROM r1 WHERE kind <> 'error'),
wx AS (SELECT *, nm AS event_name, eid AS event_id FROM wt
  UNION ALL SELECT *, '_first_open', eid || '-first-open' FROM wt WHERE k % 10 = 0
  UNION ALL SELECT *, '_session_start', eid || '-session-start' FROM wt WHERE k % 5 = 0),"""
add("parse_web_tag", lambda s, d: webtag.parse_web_tag(up.web_tag_uploads(s, d)).select(
    "event_id", "event_name", "event_timestamp", "app_id", "platform", "user_pseudo_id", "user_id", "session_id",
    "session_number", "page_view_page_title", "page_view_hostname", "device_screen_width", "geo_country", "event_value",
    "event_value_currency", F.col("custom_parameters")["theme"]["value"].alias("theme")), sql(f"""
SELECT event_id, event_name, {clock('epoch_ms(ingest)')} AS event_timestamp, 'app' || (b % 2) AS app_id,
  CASE WHEN u % 2 = 0 THEN 'macOS' ELSE 'Web' END AS platform, 'u' || u AS user_pseudo_id,
  CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END AS user_id, 's' || u AS session_id,
  CASE WHEN k % 2 = 0 THEN CAST(k AS BIGINT) END AS session_number, 'Title ' || (k % 20) AS page_view_page_title,
  'www.shop.example.com' AS page_view_hostname, 1024 AS device_screen_width, 'NATION_' || (u % 25) AS geo_country,
  CASE WHEN kind = 'purchase' THEN val END AS event_value, CASE WHEN kind = 'purchase' THEN 'EUR' END AS event_value_currency,
  'x' || (k % 4) AS theme FROM wx""", _WT))
add("web_tag_items", lambda s, d: webtag.web_tag_items(webtag.parse_web_tag(up.web_tag_uploads(s, d))).select(
    "event_id", "item_id", "name", "price", "currency"), sql("""
SELECT eid AS event_id, 'i' || (k % 10) AS item_id, 'thing' AS name, val AS price, 'EUR' AS currency FROM wt
WHERE kind = 'purchase'""", _WT))
add("parse_alt_sdk", lambda s, d: altsdk.parse_alt_sdk(up.alt_sdk_uploads(s, d)).select(
    "event_id", "event_name", "platform", "user_pseudo_id", "user_id", "page_view_page_title", "device_network_type",
    "user_engagement_time_msec", "geo_city", "sdk_version", "app_version",
    F.col("custom_parameters")["theme"]["value"].alias("theme")), sql("""
SELECT eid || sfx AS event_id, CASE WHEN sfx <> '' THEN '_first_open' ELSE nm END AS event_name,
  CASE WHEN u % 3 <> 0 THEN 'Android' ELSE 'Web' END AS platform, 'u' || u AS user_pseudo_id,
  CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) ELSE 'a' || u END AS user_id, 'Title ' || (k % 20) AS page_view_page_title,
  CASE WHEN k % 2 = 0 THEN 'WIFI' ELSE 'CELLULAR' END AS device_network_type, CAST(k * 5 AS BIGINT) AS user_engagement_time_msec,
  'city' || (u % 7) AS geo_city, '1.26' AS sdk_version, '1.' || (k % 4) AS app_version, 'x' || (k % 4) AS theme
FROM (SELECT *, 'r' || b || '-' || pos || '-u' || u AS eid, CASE kind WHEN 'view' THEN '_page_view' WHEN 'click' THEN '_click'
  ELSE kind END AS nm FROM r1), (VALUES (''), ('-first-open')) t(sfx) WHERE sfx = '' OR k % 10 = 0"""))


def _third_party_users(s, d):
    rows = webtag.parse_web_tag(up.web_tag_uploads(s, d))
    return tables.extract_users(rows, third_party=True).select(
        "app_id", "user_pseudo_id", "user_id", "event_timestamp", "first_touch_time_msec", "first_referrer")


add("users_3p", _third_party_users, sql(f"""
SELECT q.app_id, q.user_pseudo_id, q.user_id, {clock('epoch_ms(q.last)')} AS event_timestamp, f.ms - 100 AS first_touch_time_msec,
  CASE WHEN f.k % 3 = 0 THEN '{up.PARTNER}' END AS first_referrer
FROM (SELECT 'app' || (b % 2) AS app_id, 'u' || u AS user_pseudo_id, max(CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END) AS user_id,
    max(ingest) AS last FROM wx GROUP BY ALL) q
JOIN (SELECT * FROM wx QUALIFY row_number() OVER (PARTITION BY b % 2, u ORDER BY ingest, event_id) = 1) f
  ON q.app_id = 'app' || (f.b % 2) AND q.user_pseudo_id = 'u' || f.u""", _WT))

# -------------------------------------------------------- lengths, duplicates

add("max_bytes", lambda s, d: text.max_bytes(s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), {"text": 99})
    .select("doc_id", "text", "text_truncated", F.octet_length("text").alias("bytes")), """
SELECT doc_id, cut AS text, octet_length(encode(text)) > 99 AS text_truncated, octet_length(encode(cut)) AS bytes FROM (
  SELECT doc_id, text, CASE WHEN octet_length(encode(text)) <= 99 THEN text ELSE (
    SELECT max_by(substring(text, 1, g), g) FROM (SELECT unnest(generate_series(1, 99)) AS g)
    WHERE octet_length(encode(substring(text, 1, g))) <= 99) END AS cut FROM documents)""")


_LIMITS = {"event_id": 4, "event_name": 9, "platform": 3, "missing": 1}
add("max_bytes_tables", lambda s, d: tables.limited(tables.extract_events(parsed(s, d), "job-1", AT), _LIMITS)[0].select(
    "event_id", "event_name", "platform", "event_id_truncated", "event_name_truncated", "platform_truncated"), sql("""
SELECT event_id[:4] AS event_id, name[:9] AS event_name, platform[:3] AS platform, length(event_id) > 4 AS event_id_truncated,
  length(name) > 9 AS event_name_truncated, length(platform) > 3 AS platform_truncated FROM pe"""))
add("max_bytes_side_output", lambda s, d: tables.limited(tables.extract_items(parsed(s, d)), {"item_id": 2, "name": 6})[1].select(
    "event_id", "item_id", "name"), sql("""
SELECT event_id, 'i' || (k % 10 + j) AS item_id, 'item ' || (k % 10) AS name FROM pe, (VALUES (0), (1)) t(j)
WHERE kind = 'purchase' AND (length('i' || (k % 10 + j)) > 2 OR length('item ' || (k % 10)) > 6)"""))


def _dup(s, d):
    from eventloom.adapt import with_duplicates
    return with_duplicates(b.events(s, d))


_DUPE = """
dup AS (SELECT * FROM ev UNION ALL SELECT * REPLACE (created_time + INTERVAL 1 HOUR AS created_time, event_value + 1 AS event_value)
  FROM ev WHERE n % 10 = 0),"""
add("dedupe_events", lambda s, d: dedupe.dedupe_events(_dup(s, d)).select("event_id", "event_name", "event_value", "created_time"),
    with_base(f"""SELECT event_id, event_name, round(event_value, 8) AS event_value, {clock('created_time')} AS created_time FROM dup
QUALIFY row_number() OVER (PARTITION BY event_id, event_timestamp ORDER BY created_time DESC) = 1""", _DUPE))


def _items(s, d):
    rows = _dup(s, d).where("event_name = 'purchase'").withColumn("item_id", F.concat(F.lit("i"), F.col("custom_parameters")["k"]["value"]))
    return dedupe.dedupe_items(rows.select("event_id", "user_pseudo_id", "item_id", "event_timestamp", "created_time",
                                           F.col("event_value").alias("price")))


add("dedupe_items", lambda s, d: _items(s, d).select("event_id", "item_id", "price"), with_base("""
SELECT event_id, 'i' || k AS item_id, round(event_value, 8) AS price FROM dup WHERE event_name = 'purchase'
QUALIFY row_number() OVER (PARTITION BY event_id, user_pseudo_id, event_timestamp ORDER BY created_time DESC) = 1""", _DUPE))
add("dedupe_users", lambda s, d: dedupe.dedupe_users(b.events(s, d).select(
    "user_pseudo_id", "event_timestamp", "event_name", "app_version")).select("user_pseudo_id", "event_name", "app_version"),
    with_base("""SELECT user_pseudo_id, event_name, app_version FROM ev
QUALIFY row_number() OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp DESC) = 1"""))

# -------------------------------------------------------- sessions, base view


def _half_sessions(s, d, first: bool):
    cut = F.col("event_timestamp") < F.lit("2024-01-15 12:00:00").cast("timestamp")
    rows = b.events(s, d).where(cut if first else ~cut)
    # Later events carry a shorter session id, so that sessions span both halves.
    week = F.concat(F.col("user_pseudo_id"), F.lit("-"), F.date_format(F.date_trunc("week", "event_timestamp"), "yyyyMMdd"))
    return sessions.extract_sessions(rows.withColumn("session_id", week))


_SM = """
hs AS (SELECT *, event_timestamp < TIMESTAMP '2024-01-15 12:00:00' AS early, user_pseudo_id || '-' || strftime(date_trunc('week', event_timestamp), '%Y%m%d') AS sid
  FROM ev WHERE event_name IN ('_session_start','_page_view','_user_engagement','_screen_view','_app_end')),
hx AS (SELECT * FROM hs QUALIFY row_number() OVER (PARTITION BY sid, early ORDER BY
  CASE WHEN coalesce(traffic_source_source, 'Direct') <> 'Direct' THEN 0 ELSE 1 END, event_timestamp) = 1),"""
add("merge_sessions", lambda s, d: sessions.merge_sessions(_half_sessions(s, d, True), _half_sessions(s, d, False)).select(
    "user_pseudo_id", "session_id", "event_timestamp", "session_source", "session_medium"), with_base(f"""
SELECT coalesce(o.user_pseudo_id, n.user_pseudo_id) AS user_pseudo_id, coalesce(o.sid, n.sid) AS session_id,
  CASE WHEN {{t}} THEN {clock('n.event_timestamp')} ELSE {clock('o.event_timestamp')} END AS event_timestamp,
  CASE WHEN {{t}} THEN n.traffic_source_source ELSE o.traffic_source_source END AS session_source,
  CASE WHEN {{t}} THEN n.traffic_source_medium ELSE o.traffic_source_medium END AS session_medium
FROM (SELECT * FROM hx WHERE early) o FULL JOIN (SELECT * FROM hx WHERE NOT early) n ON o.sid = n.sid""".replace(
    "{t}", "(o.sid IS NULL OR (n.sid IS NOT NULL AND (o.traffic_source_source IS NULL OR "
           "(o.traffic_source_source = 'Direct' AND n.traffic_source_source IS NOT NULL))))"), _SM))
add("base_view", lambda s, d: view.base_view(_dup(s, d), b.sessions(s, d)).select(
    "event_id", "event_name", "event_value", "session_id", "session_source", "session_medium", "view_session_indicator",
    "view_event_indicator"), with_base("""
SELECT event_id, event_name, round(event_value, 8) AS event_value, q.session_id, session_source, session_medium,
  CASE WHEN event_name IN ('_page_view','_screen_view') THEN q.session_id END AS view_session_indicator,
  CASE WHEN event_name IN ('_page_view','_screen_view') THEN event_id END AS view_event_indicator
FROM (SELECT * FROM dup QUALIFY row_number() OVER (PARTITION BY event_id, event_timestamp ORDER BY created_time DESC) = 1) q
LEFT JOIN se ON se.session_id = q.session_id AND se.user_pseudo_id = q.user_pseudo_id""", _DUPE))
add("indicators", lambda s, d: view.indicators(b.events(s, d)).select("event_id", "view_session_indicator", "view_event_indicator"),
    with_base("""SELECT event_id, CASE WHEN event_name IN ('_page_view','_screen_view') THEN session_id END AS view_session_indicator,
  CASE WHEN event_name IN ('_page_view','_screen_view') THEN event_id END AS view_event_indicator FROM ev"""))
add("event_user_view", lambda s, d: b.user_events(s, d).select(
    "event_id", "latest_user_id", "merged_user_id", "new_user_indicator", "is_first_day_event", "first_traffic_source"), with_base("""
SELECT event_id, latest_user_id, merged_user_id, CASE WHEN event_name = '_first_open' THEN merged_user_id END AS new_user_indicator,
  CASE WHEN event_date = CAST(epoch_ms(first_touch_time_msec) AS DATE) THEN 'true' ELSE 'false' END AS is_first_day_event,
  first_traffic_source FROM vw"""))

# ------------------------------------------------------------ first layout (v1)


def v1(s, d):
    return legacy.ods_events(good(s, d))


_V = "p.value.double_value AS d, p.value.int_value AS i, p.value.string_value AS t"


def _kv(s, d):
    rows = v1(s, d).select("event_id", F.explode("event_params").alias("p")).where(
        F.col("p.key").isin("size", "color", "flag", "obj", "_session_duration", "_traffic_source_source", "_entrances"))
    return rows.select("event_id", F.col("p.key").alias("key"), F.col("p.value.int_value").alias("whole"),
                       F.col("p.value.double_value").alias("real"), F.col("p.value.string_value").alias("text"))


_PARAMS = """
pm AS (SELECT event_id, event_timestamp, et, app_id, name, key, whole, text FROM pe, LATERAL (VALUES ('size', CAST(k AS BIGINT), NULL),
  ('color', NULL, 'c' || (k % 4)), ('flag', NULL, CASE WHEN k % 2 = 1 THEN 'true' ELSE 'false' END), ('obj', NULL, '{"a":' || k || '}'),
  ('_session_duration', CAST(k * 1000 AS BIGINT), NULL), ('_entrances', NULL, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END))
  t(key, whole, text)),"""
add("kv_params", _kv, sql("SELECT event_id, key, whole, CAST(NULL AS DOUBLE) AS real, text FROM pm", _PARAMS))
add("event_params_long", lambda s, d: legacy.event_parameters(v1(s, d)).where(
    F.col("event_param_key").isin("size", "color", "flag")).select(
    "app_id", "event_date", "event_timestamp", "event_id", "event_name", "event_param_key", "event_param_int_value",
    "event_param_string_value"), sql(f"""
SELECT app_id, CAST(CAST(epoch_ms(et) AS DATE) AS VARCHAR) AS event_date, et AS event_timestamp, event_id, name AS event_name,
  key AS event_param_key, whole AS event_param_int_value, text AS event_param_string_value FROM pm WHERE key IN ('size','color','flag')""",
    _PARAMS))
add("project_v1", lambda s, d: legacy.project_v1(v1(s, d)).select(
    "event_id", "event_name", F.col("app_info.install_source").alias("install_source"),
    F.col("device.vendor_id").alias("vendor_id"), "event_bundle_sequence_id", "event_server_timestamp_offset",
    F.col("traffic_source.source").alias("source"), F.size("items").alias("n_items"), F.size("privacy_info").alias("privacy")),
    sql("""SELECT event_id, name AS event_name, 'ch' || (k % 2) AS install_source, 'd' || u || '-' || (k % 3) AS vendor_id,
  b AS event_bundle_sequence_id, ingest - et AS event_server_timestamp_offset, CASE WHEN k % 7 = 0 THEN 'tss' END AS source,
  CASE WHEN kind = 'purchase' THEN CASE WHEN k % 4 = 0 THEN 4 ELSE 3 END END AS n_items, 3 AS privacy FROM pe"""))
_ITEMS = """
it AS (SELECT app_id, 'i' || (k % 10 + j) AS id, et, event_id, pos2, CASE pos2 WHEN 0 THEN 'red' WHEN 1 THEN 'blue' ELSE 'grey' END AS color, val
  FROM pe, (VALUES (0, 0), (1, 1), (0, 2)) t(j, pos2) WHERE kind = 'purchase'),"""
add("latest_items", lambda s, d: legacy.latest_items(v1(s, d)).select("app_id", "id", "event_timestamp", F.filter(
    "properties", lambda p: p["key"] == "color")[0]["value"]["string_value"].alias("color")), sql("""
SELECT app_id, id, et AS event_timestamp, color FROM it QUALIFY row_number() OVER (PARTITION BY app_id, id
  ORDER BY et DESC, event_id DESC, pos2 DESC) = 1""", _ITEMS))
_U1 = """
ue AS (SELECT * FROM pe WHERE name IN ('_profile_set','_first_open','_first_visit','_app_end','_app_start')),
u1 AS (SELECT app_id, user_pseudo_id, max(et) AS event_timestamp, min(ms - 86400000) AS user_first_touch_timestamp,
  string_agg(DISTINCT CASE WHEN name = '_app_start' THEN 'd' || u || '-' || (k % 3) END, ',' ORDER BY
    CASE WHEN name = '_app_start' THEN 'd' || u || '-' || (k % 3) END) AS device_ids FROM ue GROUP BY ALL),
ur AS (SELECT *, row_number() OVER (PARTITION BY app_id, user_pseudo_id ORDER BY et, event_id) AS rn FROM ue
  WHERE name IN ('_first_open','_first_visit') AND k % 8 IN (5, 6, 7)),
ut AS (SELECT *, row_number() OVER (PARTITION BY app_id, user_pseudo_id ORDER BY et, event_id) AS rn FROM ue
  WHERE name = '_app_end' AND k % 7 = 0),
up1 AS (SELECT *, row_number() OVER (PARTITION BY app_id, user_pseudo_id ORDER BY et DESC, event_id DESC) AS rn FROM ue
  WHERE name = '_profile_set'),"""
add("user_profile_v1", lambda s, d: legacy.user_profile_v1(v1(s, d)).select(
    "app_id", "user_pseudo_id", "event_timestamp", "user_id", "user_first_touch_timestamp", "first_referer",
    "first_traffic_source", F.array_join("device_id_list", ",").alias("device_ids")), sql(f"""
SELECT u1.app_id, u1.user_pseudo_id, u1.event_timestamp, up1.user_id, u1.user_first_touch_timestamp,
  CASE ur.k % 8 WHEN 5 THEN '{up.PAGE}' WHEN 6 THEN '{up.PARTNER}' WHEN 7 THEN '{up.SOCIAL}' END AS first_referer,
  CASE WHEN ut.n IS NOT NULL THEN 'tss' END AS first_traffic_source, device_ids
FROM u1 LEFT JOIN ur ON ur.rn = 1 AND ur.app_id = u1.app_id AND ur.user_pseudo_id = u1.user_pseudo_id
LEFT JOIN ut ON ut.rn = 1 AND ut.app_id = u1.app_id AND ut.user_pseudo_id = u1.user_pseudo_id
LEFT JOIN up1 ON up1.rn = 1 AND up1.app_id = u1.app_id AND up1.user_pseudo_id = u1.user_pseudo_id""", _U1))
add("user_props_v1", lambda s, d: v1(s, d).select("event_id", F.explode("user_properties").alias("p")).select(
    "event_id", F.col("p.key").alias("key"), F.col("p.value.int_value").alias("whole"), F.col("p.value.string_value").alias("text"),
    F.col("p.value.set_timestamp_micros").alias("set_micros")), sql("""
SELECT event_id, key, whole, text, ms * 1000 AS set_micros FROM pe, LATERAL (VALUES
  ('_user_id', NULL, CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END), ('_user_first_touch_timestamp', ms - 86400000, NULL),
  ('vip', NULL, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END), ('tier', NULL, 't' || (k % 3))) t(key, whole, text)
WHERE whole IS NOT NULL OR text IS NOT NULL"""))
_WT1 = """
w0 AS (SELECT *, CASE kind WHEN 'view' THEN '_page_view' WHEN 'signup' THEN '_profile_set' WHEN 'click' THEN '_click'
    WHEN 'purchase' THEN 'purchase' END AS nm, 'r' || b || '-' || pos || '-s' || u || '-' || CASE WHEN k % 2 = 0 THEN k ELSE 0 END AS eid
  FROM r1 WHERE kind <> 'error'),
w1 AS (SELECT *, nm AS event_name, eid AS event_id FROM w0
  UNION ALL SELECT *, '_first_open', eid || '-1' FROM w0 WHERE k % 10 = 0
  UNION ALL SELECT *, '_session_start', eid || CASE WHEN k % 10 = 0 THEN '-2' ELSE '-1' END FROM w0 WHERE k % 5 = 0),"""


def wt1(s, d):
    return legacy.web_tag_events_v1(up.web_tag_uploads(s, d))


add("web_tag_v1", lambda s, d: wt1(s, d).select(
    "event_id", "event_name", "event_timestamp", "user_pseudo_id", "user_id", "session_number"), sql("""
SELECT event_id, event_name, ms - 100 AS event_timestamp, 'u' || u AS user_pseudo_id, CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END AS user_id,
  CAST(CASE WHEN k % 2 = 0 THEN k ELSE 0 END AS BIGINT) AS session_number FROM w1""", _WT1))
add("web_tag_v1_params", lambda s, d: legacy.event_parameters(wt1(s, d)).where(
    F.col("event_param_key").isin("theme", "x-sst-system_properties.uc", "ga_session_number")).select(
    "event_id", "event_param_key", "event_param_int_value", "event_param_string_value"), sql("""
SELECT event_id, key AS event_param_key, whole AS event_param_int_value, text AS event_param_string_value FROM w1, LATERAL (VALUES
  ('theme', NULL, 'x' || (k % 4)), ('x-sst-system_properties.uc', NULL, 'NATION_' || (u % 25)),
  ('ga_session_number', CASE WHEN k % 2 = 0 THEN CAST(k AS BIGINT) END, NULL)) t(key, whole, text)
WHERE whole IS NOT NULL OR text IS NOT NULL""", _WT1))
add("web_tag_v1_users", lambda s, d: legacy.web_tag_users_v1(wt1(s, d)), sql(f"""
SELECT q.app_id, q.user_pseudo_id, q.user_id, q.event_timestamp, q.t0 AS user_first_touch_timestamp,
  CASE WHEN r.n IS NOT NULL THEN '{up.PARTNER}' END AS first_referer, CAST(CAST(epoch_ms(q.t0) AS DATE) AS VARCHAR) AS first_visit_date
FROM (SELECT 'app' || (b % 2) AS app_id, 'u' || u AS user_pseudo_id, max(CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END) AS user_id,
  max(ms - 100) AS event_timestamp, min(ms - 100) AS t0, b % 2 AS a, u FROM w1 GROUP BY ALL) q
LEFT JOIN (SELECT b % 2 AS a, u, min(n) AS n FROM w1 WHERE k % 3 = 0 GROUP BY ALL) r ON r.a = q.a AND r.u = q.u""", _WT1))
add("web_tag_v1_items", lambda s, d: legacy.latest_items(wt1(s, d)).select("app_id", "id", "event_timestamp"), sql("""
SELECT 'app' || (b % 2) AS app_id, 'i' || (k % 10) AS id, max(ms - 100) AS event_timestamp FROM w1 WHERE kind = 'purchase' GROUP BY ALL""", _WT1))
add("web_tag_v1_session_number", lambda s, d: legacy.previous_session_number(wt1(s, d), 1_705_276_800_000), sql("""
SELECT 'app' || (b % 2) AS app_id, 'u' || u AS user_pseudo_id, CAST(max(CASE WHEN k % 2 = 0 THEN k ELSE 0 END) AS BIGINT) AS max_session_number
FROM w1 WHERE ms - 100 >= 1705104000000 AND ms - 100 < 1705276800000 GROUP BY ALL""", _WT1))

# ------------------------------------------------------------------- back-fill


def old_events(s, d):
    """The first table layout as it is stored; back-fill starts from it."""
    return staged(v1(s, d), "v1")


def backfilled(s, d):
    return backfill.backfill_events(old_events(s, d))


add("backfill_event", lambda s, d: backfilled(s, d).select(
    "event_id", "event_name", "event_timestamp", "app_id", "platform", "session_id", "session_duration", "page_view_entrances",
    "screen_view_screen_id", "traffic_source_source", F.col("custom_parameters")["color"]["value"].alias("color"),
    F.col("custom_parameters")["size"]["type"].alias("size_type"), F.map_contains_key("custom_parameters", "_session_id").alias("leaked")),
    sql(f"""SELECT event_id, name AS event_name, {clock('epoch_ms(et)')} AS event_timestamp, app_id, platform, session_id,
  CAST(k * 1000 AS BIGINT) AS session_duration, k % 2 = 0 AS page_view_entrances, 'sid' || (k % 10) AS screen_view_screen_id,
  CASE WHEN k % 7 = 0 THEN 'tss' END AS traffic_source_source, 'c' || (k % 4) AS color, 'number' AS size_type, FALSE AS leaked FROM pe"""))


def _rest(s, d):
    """The events a second run still has to move when the first 15 days are done."""
    old = old_events(s, d)
    done = backfill.backfill_events(old).where(F.col("event_timestamp") < F.lit("2024-01-15").cast("timestamp"))
    return backfill.backfill_events(old, None, done, 1_704_500_000_000).select("event_id", "session_id")


def _windows(s, d):
    """A run that ends after two windows of five days, and one that moves the others."""
    old, path = old_events(s, d), scratch(s, "windows")
    span = (dt.date(2023, 12, 31), dt.date(2024, 2, 1), 5)
    backfill.backfill_windows(old, path, *span, stop_after=2)
    moved = backfill.backfill_windows(old, path, *span)
    return backfill.backfilled(s, path).select("event_id", "session_id", F.lit(len(moved)).alias("windows_left"))


add("backfill_windows", _windows, sql("SELECT event_id, session_id, 5 AS windows_left FROM pe"))


def _apart(s, d):
    """From the table of parameters that stands beside the events."""
    old = old_events(s, d)
    return backfill.backfill_events(old, legacy.event_parameters(old)).select(
        "event_id", "session_id", F.col("custom_parameters")["size"]["value"].alias("size"))


add("backfill_event_apart", _apart, sql("SELECT event_id, session_id, CAST(k AS VARCHAR) AS size FROM pe"))
add("backfill_event_resume", _rest, sql("""
SELECT event_id, session_id FROM pe WHERE epoch_ms(et) >= TIMESTAMP '2024-01-15' AND et >= 1704500000000"""))
add("backfill_user", lambda s, d: backfill.backfill_users(legacy.user_profile_v1(v1(s, d)), backfilled(s, d)).select(
    "app_id", "user_pseudo_id", "user_id", "first_touch_time_msec", F.col("user_properties")["tier"]["value"].alias("tier"),
    F.col("user_properties")["tier"]["set_time_msec"].alias("set_msec"), "first_traffic_source", "first_app_install_source",
    "first_referrer"), sql(f"""
SELECT u1.app_id, u1.user_pseudo_id, up1.user_id, u1.user_first_touch_timestamp AS first_touch_time_msec, 't' || (up1.k % 3) AS tier,
  up1.ms AS set_msec, CASE WHEN mo.user_pseudo_id IS NOT NULL THEN mo.src ELSE we.src END AS first_traffic_source,
  CASE WHEN mo.user_pseudo_id IS NOT NULL THEN mo.inst ELSE we.inst END AS first_app_install_source,
  CASE WHEN mo.user_pseudo_id IS NOT NULL THEN mo.ref ELSE we.ref END AS first_referrer
FROM u1 LEFT JOIN up1 ON up1.rn = 1 AND up1.app_id = u1.app_id AND up1.user_pseudo_id = u1.user_pseudo_id
LEFT JOIN (SELECT user_pseudo_id, max(CASE WHEN k % 7 = 0 THEN 'tss' END) AS src, max('ch' || (k % 2)) AS inst,
  max(CASE k % 8 WHEN 5 THEN '{up.PAGE}' WHEN 6 THEN '{up.PARTNER}' WHEN 7 THEN '{up.SOCIAL}' END) AS ref
  FROM pe WHERE name = '_first_open' AND platform = 'Web' GROUP BY ALL) we ON we.user_pseudo_id = u1.user_pseudo_id
LEFT JOIN (SELECT p.user_pseudo_id, max('tss') AS src, max('ch' || (k % 2)) AS inst,
  max(CASE WHEN k % 8 = 4 THEN '{up.SEARCH}' END) AS ref FROM pe p JOIN (
    SELECT user_pseudo_id, session_id FROM pe WHERE name IN ('_screen_view','_app_end') AND platform <> 'Web'
    QUALIFY row_number() OVER (PARTITION BY user_pseudo_id ORDER BY et, event_id) = 1) o
  ON o.user_pseudo_id = p.user_pseudo_id AND o.session_id = p.session_id WHERE platform <> 'Web' AND k % 7 = 0
  GROUP BY p.user_pseudo_id) mo ON mo.user_pseudo_id = u1.user_pseudo_id""", _U1))
add("backfill_session", lambda s, d: backfill.backfill_sessions(backfilled(s, d)).select(
    "app_id", "user_pseudo_id", "session_id", "user_id", "session_number", "event_timestamp", "session_source"), sql(f"""
SELECT app_id, user_pseudo_id, session_id, max(user_id) AS user_id, CAST(max(1 + k % 3) AS BIGINT) AS session_number,
  {clock('epoch_ms(max(et))')} AS event_timestamp,
  max(CASE WHEN name = '_session_start' AND k % 7 = 0 THEN 'tss' END) AS session_source FROM pe GROUP BY ALL"""))
add("backfill_item", lambda s, d: backfill.backfill_items(v1(s, d), legacy.latest_items(v1(s, d))).select(
    "event_id", "item_id", "name", "price", F.col("custom_parameters")["color"]["value"].alias("color")), sql("""
SELECT i.event_id, i.id AS item_id, 'item ' || (p.k % 10) AS name, i.val AS price, l.color FROM (SELECT DISTINCT app_id, id, et, event_id, val FROM it) i
JOIN (SELECT * FROM it QUALIFY row_number() OVER (PARTITION BY app_id, id ORDER BY et DESC, event_id DESC, pos2 DESC) = 1) l
  ON l.id = i.id AND l.et = i.et JOIN pe p ON p.event_id = i.event_id""", _ITEMS))
