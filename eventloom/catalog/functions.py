"""Scalar functions, step chains and the full metric run: query and oracle per key."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.adapt import with_session_facts

from eventloom.catalog import base as b
from eventloom.catalog import metrics
from eventloom.catalog.base import clock, day, local, with_base
from eventloom.functions import url
from eventloom.functions.props import merge, typed, variant_map
from eventloom.functions.text import cut_bytes
from eventloom.functions.timeunits import local as local_clock, local_date
from eventloom.operators.fields import FieldRule
from eventloom.plans.etl import Chain
from eventloom.plans.modelling import METRICS
from eventloom.plans.refresh import refresh_all
from eventloom.session import scratch, staged

TZ = "America/New_York"
QUERIES: dict[str, b.Query] = {}
ORACLES: dict[str, str] = {}


def add(key: str, fn: b.Query, sql: str | None = None) -> None:
    QUERIES[key] = b.query(fn)
    if sql is not None:
        ORACLES[key] = sql


def _datetime(s, d):
    at, created = F.col("event_timestamp"), F.col("created_time")
    return b.events(s, d).select(
        "event_id", local_clock("event_timestamp", TZ).alias("local"),
        *[F.date_trunc(u, at).alias(f"at_{u}") for u in ("hour", "day", "week", "month", "year")],
        F.date_format(at, "yyyyMM").alias("label"), (F.unix_micros(created) - F.unix_micros(at)).alias("gap"),
        F.datediff(F.lit("2024-02-01"), F.to_date(at)).alias("days"),
        F.floor(F.datediff(F.date_trunc("week", F.lit("2024-02-01").cast("timestamp")), F.date_trunc("week", at)) / 7).alias("weeks"),
        F.date_add(F.to_date(at), 30).alias("later"), F.from_unixtime(F.unix_timestamp(at)).alias("second"),
        local_date(F.timestamp_millis("event_time_msec"), TZ).alias("local_date"),
        F.size(F.sequence(F.to_date(at), F.lit("2024-02-01").cast("date"))).alias("list"))


add("fn_datetime", _datetime, with_base(f"""
SELECT event_id, {clock(local(TZ))} AS local, {', '.join(f"{clock(f"date_trunc('{u}', event_timestamp)".replace("date_trunc('day', event_timestamp)", "CAST(CAST(event_timestamp AS DATE) AS TIMESTAMP)"))} AS at_{u}" for u in ('hour', 'day', 'week', 'month', 'year'))},
  strftime(event_timestamp, '%Y%m') AS label, 60000000 AS gap, datediff('day', event_date, DATE '2024-02-01') AS days,
  datediff('day', CAST(date_trunc('week', event_timestamp) AS DATE), DATE '2024-01-29') // 7 AS weeks,
  CAST(event_date + 30 AS VARCHAR) AS later, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS second,
  {day(local(TZ, 'epoch_ms(event_time_msec)'))} AS local_date, datediff('day', event_date, DATE '2024-02-01') + 1 AS list FROM ev"""))


def _string(s, d):
    t = F.col("text")
    return s.read.parquet(f"{d}/documents.parquet").select(
        "doc_id", F.concat_ws(" / ", "lang", "source").alias("joined"), F.left(t, F.lit(12)).alias("head"),
        F.lpad(F.col("doc_id").cast("string"), 6, "0").alias("padded"), F.split_part(t, F.lit(" "), F.lit(2)).alias("word"),
        F.regexp_count(t, F.lit("e")).alias("n_e"), t.like("%the\\_%").alias("like_escaped"),
        F.regexp_extract(t, "([a-z]+)\\.", 1).alias("before_dot"), F.octet_length(t).alias("bytes"),
        F.octet_length(cut_bytes(t, 20)).alias("cut"))


add("fn_string", _string, """
SELECT doc_id, lang || ' / ' || source AS joined, left(text, 12) AS head, lpad(CAST(doc_id AS VARCHAR), 6, '0') AS padded,
  split_part(text, ' ', 2) AS word, len(text) - len(replace(text, 'e', '')) AS n_e, contains(text, 'the_') AS like_escaped,
  regexp_extract(text, '([a-z]+)\\.', 1) AS before_dot, octet_length(encode(text)) AS bytes,
  octet_length(encode(CASE WHEN octet_length(encode(text)) <= 20 THEN text ELSE (SELECT max_by(substring(text, 1, g), g)
    FROM (SELECT unnest(generate_series(1, 20)) AS g) WHERE octet_length(encode(substring(text, 1, g))) <= 20) END)) AS cut FROM documents""")


def _url(s, d):
    u = F.col("url")
    p = url.params(url.pairs(url.query(u)))
    return s.read.parquet(f"{d}/pages.parquet").select(
        "page_id", url.host(u).alias("host"), url.path(u).alias("path"), url.query(u).alias("query"),
        p["utm_source"].alias("utm_source"), p["ref"].alias("ref"), url.decode(F.url_encode(u)).alias("round_trip"))


add("fn_url", _url, r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
  nullif(regexp_extract(url, '\?([^#]*)', 1), '') AS query, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
  nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, url AS round_trip FROM pages""")


def _json(s, d):
    doc = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("value").alias("n"), (F.col("user_id") % 2 == 0).alias("even"),
                             F.struct(F.col("user_id").alias("id")).alias("who")))
    rows = s.read.parquet(f"{d}/events.parquet").select("event_id", doc.alias("j"))
    m = typed(variant_map(F.col("j")))
    return rows.select(
        "event_id", F.get_json_object("j", "$.who.id").alias("dotted"), m["kind"]["type"].alias("kind_type"),
        m["n"]["type"].alias("n_type"), m["even"]["value"].alias("even"), m["who"]["value"].alias("who"), m["who"]["type"].alias("who_type"),
        F.from_json("j", "kind string, n double").getField("n").alias("n"), F.variant_get(F.parse_json("j"), "$.who.id", "long").alias("who_id"))


add("fn_json", _json, """
SELECT event_id, CAST(user_id AS VARCHAR) AS dotted, 'string' AS kind_type, 'number' AS n_type,
  CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS even, '{"id":' || user_id || '}' AS who, 'object' AS who_type,
  value AS n, user_id AS who_id FROM events""")


def _maps(s, d):
    rows = b.events(s, d).groupBy("user_pseudo_id").agg(
        F.collect_set("event_name").alias("names"), F.collect_set("geo_city").alias("cities"))
    left = F.when(F.size("names") > 4, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")))
    both = merge(left, F.create_map(F.lit("b"), F.lit("3")))
    return rows.select(
        "user_pseudo_id", F.array_join(F.array_sort(F.array_distinct(F.flatten(F.array("names", "names")))), ",").alias("names"),
        F.size(F.array_union("names", "cities")).alias("both"), both["a"].alias("a"), both["b"].alias("b"),
        F.greatest(F.size("names"), F.lit(3)).alias("top"), F.least(F.size("names"), F.lit(3)).alias("low"),
        F.nullif(F.size("cities"), F.lit(1)).alias("none"), F.try_divide(F.lit(1), F.size("cities") - 1).alias("guarded"))


add("fn_map_array", _maps, with_base("""
SELECT user_pseudo_id, string_agg(DISTINCT event_name, ',' ORDER BY event_name) AS names, count(DISTINCT event_name) + 1 AS both,
  CASE WHEN count(DISTINCT event_name) > 4 THEN '1' END AS a, '3' AS b, greatest(count(DISTINCT event_name), 3) AS top,
  least(count(DISTINCT event_name), 3) AS low, CAST(NULL AS INTEGER) AS none, CAST(NULL AS DOUBLE) AS guarded FROM ev GROUP BY user_pseudo_id"""))

# ---------------------------------------------------------------- step chains

_KEEP = ["event_id", "event_name", "event_timestamp", "app_id", "user_pseudo_id", "platform", "geo_country", "app_version"]


def _chain(s, d):
    chain = Chain(
        steps=[("shout", lambda df: df.withColumn("geo_country", F.upper("geo_country"))),
               ("tag", lambda df: df.withColumn("app_version", F.concat("app_version", F.lit("+"), "geo_country")))],
        post=lambda df: df.where("platform <> 'iOS'"), rules={"app0": FieldRule("blacklist", ("geo_country",)),
                                                              "app1": FieldRule("blacklist", ("geo_country",))})
    return chain.run(b.events(s, d).select(*_KEEP), ["app0", "app1"])


add("enrich_chain", _chain, with_base(f"""
SELECT event_id, event_name, {clock('event_timestamp')} AS event_timestamp, app_id, user_pseudo_id, platform,
  app_version || '+' || geo_country AS app_version FROM ev WHERE platform <> 'iOS'"""))


def _run_all(s, d):
    """Every metric table brought up to date twice; a tenth of the events arrives twelve days late, in the second run.

    A broken metric is reported and the rest go on. What is compared is every column of every table: how many values, how
    many different ones, and the sum of those that are numbers.
    """
    path = scratch(s, "metrics")
    broken = {"broken": type(METRICS["dau"])(lambda e, u: e.select("no_such_column"), (), "")}
    late = F.when(F.substring("event_id", 2, 20).cast("long") % 10 == 0, F.expr("INTERVAL 12 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    events = staged(b.events(s, d).withColumn("created_time", F.col("created_time") + late), "events")
    users = staged(b.users(s, d), "users")
    for until in (dt.datetime(2024, 1, 17), dt.datetime(2024, 3, 1)):
        # Every metric reads the facts, so they are computed once for a run.
        facts = staged(with_session_facts(events.where(F.col("created_time") <= F.lit(until))), "facts")
        failures = refresh_all(s, facts, users, path, until, {**METRICS, **broken})
    told = []
    for name in METRICS:
        rows = b.plain(s.read.parquet(f"{path}/{name}").drop("bucket"))
        columns = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in rows.columns]
        told.append(rows.select(F.lit(name).alias("metric"), F.explode(F.array(*columns)).alias("c")).select("metric", "c.*"))
    number = F.col("value").try_cast("double")
    return functools.reduce(DataFrame.unionByName, told).where("value IS NOT NULL").groupBy("metric", "column").agg(
        F.count("value").alias("n"), F.countDistinct("value").alias("different"), F.round(F.sum(number), 4).alias("total")).withColumn(
        "failed", F.lit(",".join(failures)))


# Table -> the key whose oracle says what is in it; the content of each is compared under that key.
_SAME = {"event_daily_summary": "event_daily", "event_hourly_summary": "event_hourly", "new_return_user": "new_return",
         "device": "device_usage", "geo_user": "geo_new_user", "page_screen_view": "page_view", "exit": "exit_page",
         "user_acquisition": "acquisition"}
_OWN = {"event_name": with_base("""SELECT app_id, event_date, platform, user_pseudo_id AS user_id, event_name, count(*) AS event_count,
  round(sum(coalesce(event_value, 0)), 8) AS event_value FROM ev GROUP BY ALL"""),
        "crash_rate": with_base("""SELECT DISTINCT app_id, event_date, platform, app_version, user_pseudo_id AS user_id,
  CASE WHEN event_name = '_app_exception' THEN user_pseudo_id END AS crashed_user_id FROM ev""")}
add("run_all_metrics", _run_all, "SELECT metric, \"column\", count(value) AS n, count(DISTINCT value) AS different,"
    " round(sum(try_cast(value AS DOUBLE)), 4) AS total, 'broken' AS failed FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, \"column\", value FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM ({_OWN.get(name) or metrics.ORACLES[_SAME.get(name, name)]})) "
        f"ON COLUMNS(*) INTO NAME \"column\" VALUE value)" for name in METRICS) + ") GROUP BY metric, \"column\"")
