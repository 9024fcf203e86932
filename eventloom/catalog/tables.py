"""Sources, sinks, upserts, state and expiry: query and oracle per key.

These queries write derived rows into a fresh scratch folder and read them back,
so what is compared went through the files.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from eventloom import uploads as up
from eventloom.adapt import with_duplicates
from eventloom.catalog import base as b
from eventloom.catalog import etl
from eventloom.catalog.base import clock, day, with_base
from eventloom.operators import clean, tables, upsert as ups
from eventloom.operators.metrics import activity, behaviour
from eventloom.session import scratch
from eventloom.sources import ods, raw, rules, state

QUERIES: dict[str, b.Query] = {}
ORACLES: dict[str, str] = {}
MID = dt.date(2024, 1, 15)


def add(key: str, fn: b.Query, sql: str | None = None) -> None:
    QUERIES[key] = b.query(fn)
    if sql is not None:
        ORACLES[key] = sql


def until(df, d: dt.date):
    return df.where(F.col("event_timestamp") < F.lit(d).cast("timestamp"))


def since(df, d: dt.date):
    return df.where(F.col("event_timestamp") >= F.lit(d).cast("timestamp"))


# ------------------------------------------------------------------ raw files


def _raw_folder(s, d):
    """Uploads as text lines in hour folders; some lines are cut off."""
    path = scratch(s, "raw")
    rows = up.sdk_uploads(s, d)
    at = F.timestamp_millis("ingest_time")
    n = F.substring("rid", 2, 20).cast("long")
    line = F.to_json(F.struct(*rows.columns))
    (rows.select(F.when(n % 40 == 5, F.substring(line, 1, 30)).otherwise(line).alias("value"), F.year(at).alias("year"),
                 F.month(at).alias("month"), F.dayofmonth(at).alias("day"), F.hour(at).alias("hour_of_day"))
     .write.partitionBy(*raw.PARTITIONS).text(path))
    return path


_INGEST = "up AS (SELECT b, max(ingest) AS ingest FROM r1 GROUP BY b),"
add("scan_raw", lambda s, d: raw.read_raw(s, _raw_folder(s, d)).select(
    "rid", "ingest_time", F.col("_corrupt_record").isNotNull().alias("broken"),
    F.col("input_file_name").contains("/year=2024/").alias("named")), etl.sql("""
SELECT CASE WHEN b % 40 <> 5 THEN 'r' || b END AS rid, CASE WHEN b % 40 <> 5 THEN ingest END AS ingest_time,
  b % 40 = 5 AS broken, TRUE AS named FROM up""", _INGEST))


def _window(s, d):
    path = _raw_folder(s, d)
    now, hour = dt.datetime.now(dt.timezone.utc), dt.timedelta(hours=1)
    count = lambda label, lo, hi: raw.read_raw(s, path, lo, hi).agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("files"), "n")
    return count("written now", now - hour, now + hour).unionByName(count("written before", now - 9 * hour, now - 2 * hour))


add("scan_raw_window", _window, etl.sql("""
SELECT 'written now' AS files, count(*) AS n FROM up UNION ALL SELECT 'written before', 0""", _INGEST))
add("scan_partition_range", lambda s, d: raw.read_partitions(s, _raw_folder(s, d), dt.date(2024, 1, 5), dt.date(2024, 1, 9)).groupBy(
    "year", "month", "day").agg(F.count(F.lit(1)).alias("uploads")), etl.sql("""
SELECT 2024 AS year, 1 AS month, CAST(day(epoch_ms(ingest)) AS INTEGER) AS day, count(*) AS uploads FROM up
WHERE epoch_ms(ingest) >= TIMESTAMP '2024-01-05' AND epoch_ms(ingest) < TIMESTAMP '2024-01-10' GROUP BY ALL""", _INGEST))


def _rules(s, d):
    """A rule file per app, naming the countries its events come from."""
    path = scratch(s, "rules")
    doc = b.events(s, d).groupBy("app_id").agg(F.array_sort(F.collect_set("geo_country")).alias("fields")).select(
        "app_id", F.lit("whitelist").alias("filterMode"), "fields")
    doc.repartition("app_id").write.partitionBy("app_id").json(path)
    found = rules.load_rules(s, path)
    return found.select("app", F.get_json_object("text", "$.filterMode").alias("mode"),
                        F.json_array_length(F.get_json_object("text", "$.fields")).alias("fields"))


add("rules_scan", _rules, with_base("""
SELECT app_id AS app, 'whitelist' AS mode, count(DISTINCT geo_country) AS fields FROM ev GROUP BY app_id"""))

# -------------------------------------------------------------- stored tables


def _few(s, d):
    return b.events(s, d).select("app_id", "event_id", "event_timestamp", "event_name", "user_pseudo_id", "session_id",
                                 "event_value", "created_time")


def _stored(s, d, fmt="parquet"):
    path = scratch(s, "ods")
    rows = _few(s, d)
    ods.write_ods(rows, path, fmt)
    return path, rows.schema


def _read_window(s, d):
    path, schema = _stored(s, d)
    at = lambda *a: dt.datetime(*a, tzinfo=dt.timezone.utc)
    found = ods.read_ods(s, path, schema, at(2024, 1, 5, 6), at(2024, 1, 9, 12))
    return found.unionByName(ods.read_ods(s, path + "-missing", schema)).select("event_id", "event_timestamp", "event_value")


add("ods_read", _read_window, with_base(f"""
SELECT event_id, {clock('event_timestamp')} AS event_timestamp, event_value FROM ev
WHERE event_timestamp >= TIMESTAMP '2024-01-05 06:00:00' AND event_timestamp < TIMESTAMP '2024-01-09 12:00:00'"""))
_FOLDERS = with_base("""
SELECT app_id AS partition_app, strftime(event_timestamp, '%Y') AS partition_year, strftime(event_timestamp, '%m') AS partition_month,
  strftime(event_timestamp, '%d') AS partition_day, count(*) AS n, round(sum(event_value), 8) AS value FROM ev GROUP BY ALL""")


def _folders(s, path, fmt):
    text = ", ".join(f"{p} string" for p in ods.PARTITIONS)
    rows = s.read.schema(f"event_id string, event_value double, {text}").format(fmt).load(path)
    return rows.groupBy(*ods.PARTITIONS).agg(F.count("event_id").alias("n"), F.sum("event_value").alias("value"))


add("ods_write", lambda s, d: _folders(s, _stored(s, d)[0], "parquet"), _FOLDERS)
add("ods_write_json", lambda s, d: _folders(s, _stored(s, d, "json")[0], "json"), _FOLDERS)
add("out_sizing", lambda s, d: ods.output_partitions(b.events(s, d)), with_base("""
SELECT rows, folders, CAST(ceil(rows / 50000.0) AS BIGINT) + folders AS files FROM (
  SELECT count(*) AS rows, count(DISTINCT (app_id, event_date)) AS folders FROM ev)"""))
add("approx_distinct", lambda s, d: b.events(s, d).groupBy("platform").agg(
    F.approx_count_distinct("user_pseudo_id", 0.005).alias("users")), with_base("""
SELECT platform, count(DISTINCT user_pseudo_id) AS users FROM ev GROUP BY platform"""))


def _rejects(s, d):
    path = scratch(s, "rejects")
    bad = clean.split_corrupt(etl.entries(s, d))[1]
    ods.write_rejects(bad, path, "job-1")
    return s.read.schema("reason string, rid string, data string, job_name string").json(path).groupBy(
        "job_name", "reason").agg(F.count("data").alias("n"))


add("reject_sink", _rejects, etl.sql("""
SELECT 'job-1' AS job_name, reason, count(*) AS n FROM (SELECT CASE WHEN n % 103 = 0 THEN 'event_id' WHEN n % 101 = 0 THEN 'app_id'
  ELSE 'timestamp' END AS reason FROM ent WHERE fine AND (n % 103 = 0 OR n % 101 = 0 OR n % 107 = 0)
  UNION ALL SELECT 'corrupt' FROM (SELECT DISTINCT b FROM ent WHERE NOT fine)) GROUP BY reason"""))


def _view(s, d):
    return ods.ods_view(s, _stored(s, d)[0], "app1", dt.date(2024, 1, 20)).select("event_id", "event_name")


add("ods_view", _view, with_base("""
SELECT event_id, event_name FROM ev WHERE app_id = 'app1' AND event_timestamp >= TIMESTAMP '2024-01-20'"""))
add("ods_view_joined", lambda s, d: ods.event_user_session(_few(s, d), b.users(s, d), b.sessions(s, d)).select(
    "event_id", "first_traffic_source", "session_source"), with_base("""
SELECT event_id, first_traffic_source, session_source FROM vw"""))


def _batch(s, d):
    path = scratch(s, "batch")
    rows = with_duplicates(b.events(s, d)).select("event_id", "event_timestamp", "event_value", "created_time")
    ods_a, ods_b = f"{path}/a", f"{path}/b"
    until(rows, MID).write.parquet(ods_a)
    since(rows, MID).write.parquet(ods_b)
    return ods.load_batch(s, [ods_a, ods_b], ["event_id", "event_timestamp"], ["created_time"]).select("event_id", "event_value")


add("load_batch", _batch, with_base("""SELECT event_id, round(event_value, 8) AS event_value FROM dup
QUALIFY row_number() OVER (PARTITION BY event_id, event_timestamp ORDER BY created_time DESC) = 1""", etl._DUPE))

# -------------------------------------------------------------------- upserts


def _table(s, rows, keys, partitions):
    return ups.MetricTable(s, scratch(s, "metric"), rows.schema, keys, partitions)


def _upsert(s, d):
    """Days 1-15, then days 10-31 again with all their events, twice."""
    whole = b.events(s, d)
    keys = ["app_id", "event_date", "platform"]
    first = activity.dau(until(whole, MID))
    t = _table(s, first, keys, ["event_date"])
    t.upsert(first)
    late = activity.dau(since(whole, dt.date(2024, 1, 10)))
    t.upsert(late)
    t.upsert(late)
    return t.read()


add("upsert_replace", _upsert, with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, count(DISTINCT user_pseudo_id) AS user_count FROM ev GROUP BY ALL"""))


def _accumulate(s, d):
    whole = b.events(s, d)
    first = behaviour.user_behavior(until(whole, MID)).withColumn("bucket", F.pmod(F.xxhash64("user_pseudo_id"), F.lit(16)))
    t = _table(s, first, ["bucket", "app_id", "user_id", "user_pseudo_id"], ["bucket"])
    t.append(first)
    later = behaviour.user_behavior(since(whole, MID)).withColumn("bucket", F.pmod(F.xxhash64("user_pseudo_id"), F.lit(16)))
    t.accumulate(later, {"first_visit_date": ups.LEAST, "last_visit_date": ups.GREATEST, "total_sessions": ups.ADD,
                         "total_events": ups.ADD, "ltv": ups.ADD})
    return t.read().drop("bucket")


add("upsert_accumulate", _accumulate, with_base(f"""
SELECT app_id, user_id, user_pseudo_id, {day('min(event_date)')} AS first_visit_date, {day('max(event_date)')} AS last_visit_date,
  count(DISTINCT session_id) AS total_sessions, count(*) AS total_events, round(sum(coalesce(event_value, 0)), 8) AS ltv
FROM ev GROUP BY ALL"""))


def _rerun_upsert(s, d):
    """The second batch dies while it replaces partitions and is run again; the first, run again later, does nothing."""
    whole = b.events(s, d)
    first, late = activity.dau(until(whole, MID)), activity.dau(since(whole, dt.date(2024, 1, 10)))
    t = _table(s, first, ["app_id", "event_date", "platform"], ["event_date"])
    t.upsert(first, "b1")
    _dies(t, lambda: t.upsert(late, "b2"))
    t.upsert(late, "b2")
    t.upsert(first, "b1")
    return t.read()


def _dies(t, change):
    """Runs a change up to the point where it has emptied the partitions that it was about to replace."""
    real = t._overwrite
    t._overwrite = lambda rows: real(rows.limit(0).unionByName(rows.limit(1)))
    mark, t.spark = t.spark, _NoDone(t.spark)
    try:
        change()
    except ConnectionError:
        pass
    finally:
        t._overwrite, t.spark = real, mark


class _NoDone:
    """A session whose driver is lost before it can record a batch as done."""

    def __init__(self, spark):
        self.spark = spark

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def range(self, n):
        raise ConnectionError("driver lost")


add("upsert_rerun", _rerun_upsert, with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, count(DISTINCT user_pseudo_id) AS user_count FROM ev GROUP BY ALL"""))


def _rerun_accumulate(s, d):
    """Every batch is run twice, the second dies once in between; sums count each event once."""
    def totals(rows):
        return rows.groupBy(F.pmod(F.xxhash64("user_pseudo_id"), F.lit(16)).alias("bucket"), "user_pseudo_id").agg(
            F.count("*").alias("events"), F.max("event_timestamp").alias("last_seen"))

    whole = b.events(s, d)
    first, later = totals(until(whole, MID)), totals(since(whole, MID))
    t, how = _table(s, first, ["bucket", "user_pseudo_id"], ["bucket"]), {"events": ups.ADD, "last_seen": ups.GREATEST}
    t.accumulate(first, how, "b1")
    t.accumulate(first, how, "b1")
    _dies(t, lambda: t.accumulate(later, how, "b2"))
    t.accumulate(later, how, "b2")
    t.accumulate(later, how, "b2")
    return t.read().drop("bucket")


add("accumulate_rerun", _rerun_accumulate, with_base(f"""
SELECT user_pseudo_id, count(*) AS events, {clock('max(event_timestamp)')} AS last_seen FROM ev GROUP BY user_pseudo_id"""))


def _dedup(s, d):
    """Corrected copies of every tenth event replace the stored ones."""
    whole = with_duplicates(b.events(s, d)).select("event_id", "event_timestamp", "event_value", "created_time").withColumn(
        "event_date", F.to_date("event_timestamp"))
    again = F.col("created_time") > F.col("event_timestamp") + F.expr("INTERVAL 30 MINUTES")
    t = _table(s, whole, ["event_date", "event_id", "event_timestamp"], ["event_date"])
    t.append(whole.where(~again))
    t.upsert(whole.where(again))
    return t.read().select("event_id", "event_value")


add("upsert_dedup", _dedup, with_base("""
SELECT event_id, round(CASE WHEN n % 10 = 0 THEN event_value + 1 ELSE event_value END, 8) AS event_value FROM ev"""))


def _refresh(s, d):
    """A table built without purchases, of which the last five days are refreshed."""
    whole = b.events(s, d)
    old = activity.day_event_view(whole.where("event_name <> 'purchase'"))
    t = _table(s, old, ["app_id", "event_date", "platform"], ["event_date"])
    t.append(old)
    t.refresh_days(ups.last_days(activity.day_event_view(whole), "event_date", dt.date(2024, 1, 25), 5))
    return t.read()


add("refresh_days", _refresh, with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform,
  count(DISTINCT CASE WHEN event_name <> 'purchase' OR event_date BETWEEN DATE '2024-01-21' AND DATE '2024-01-25' THEN event_id END) AS event_count,
  count(DISTINCT CASE WHEN event_name IN ('_page_view','_screen_view') THEN event_id END) AS view_count FROM ev GROUP BY app_id, ev.event_date, platform
HAVING event_count > 0"""))


def _create(s, d):
    name = f"metric_{uuid.uuid4().hex[:12]}"
    ups.create_metric_table(s, name, "app_id string, platform string, user_count bigint, event_date date", ["event_date"],
                            scratch(s, "table"))
    activity.dau(b.events(s, d)).select("app_id", "platform", "user_count", "event_date").write.insertInto(name)
    return s.table(name).where("event_date >= DATE '2024-01-20'")


add("create_table", _create, with_base(f"""
SELECT app_id, platform, count(DISTINCT user_pseudo_id) AS user_count, {day('event_date')} AS event_date FROM ev
WHERE event_date >= DATE '2024-01-20' GROUP BY ALL"""))


def _sync(s, d):
    name, path = f"synced_{uuid.uuid4().hex[:12]}", scratch(s, "sync")
    ups.create_metric_table(s, name, "event_id string, event_name string, app_id string, event_date date", ["app_id", "event_date"], path)
    rows = b.events(s, d).select("event_id", "event_name", "app_id", F.to_date("event_timestamp").alias("event_date"))
    ups.append_rows(rows.where("event_date < '2024-01-10'"), name)
    # The rest is written by a job that knows nothing of the catalog.
    later = rows.where("event_date >= '2024-01-10'")
    later.repartition("app_id", "event_date").write.partitionBy("app_id", "event_date").mode("append").parquet(path)
    return ups.sync_partitions(s, name, later)


add("partition_sync", _sync, with_base("""
SELECT DISTINCT 'app_id=' || app_id || '/event_date=' || CAST(event_date AS VARCHAR) AS partition FROM ev"""))

# ------------------------------------------------------------- state, expiry


def _state(s, d):
    """Two increments, a compaction, a third increment; the first day's rows are too old by then."""
    parts = tables.partial_users(tables.user_rows(etl.parsed(s, d))).drop("process_info")
    table = state.StateTable(s, scratch(s, "state"), parts.schema, keep_days=30)
    rows = lambda lo, hi: parts.where(F.col("event_timestamp").between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
    table.append(rows("2024-01-01", "2024-01-10"), dt.date(2024, 1, 1))
    table.append(rows("2024-01-01", "2024-03-01"), dt.date(2024, 2, 1))
    merged = lambda df: tables.merge_users(df.withColumn("process_info", F.lit(None).cast("map<string,string>"))).drop("process_info")
    table.compact(merged, dt.date(2024, 2, 20))
    return table.read(dt.date(2024, 2, 20)).select("app_id", "user_pseudo_id", "user_id", "event_timestamp",
                                                   F.col("first.name").alias("first_event"))


add("state_table", _state, etl.sql("SELECT app_id, user_pseudo_id, user_id, event_timestamp, first_event FROM uo", etl._USERS))
add("expire_relative", lambda s, d: ups.expire(b.events(s, d), "event_timestamp", 7).select("event_id"), with_base("""
SELECT event_id FROM ev WHERE event_timestamp >= (SELECT max(event_timestamp) FROM ev) - INTERVAL 7 DAY"""))
add("expire_today", lambda s, d: ups.expire_today(activity.dau(b.events(s, d)), "event_date", 10, dt.date(2024, 1, 30)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, count(DISTINCT user_pseudo_id) AS user_count FROM ev
WHERE event_date >= DATE '2024-01-20' GROUP BY ALL"""))


def _two_runs(s, d):
    return etl._half_sessions(s, d, True).unionByName(etl._half_sessions(s, d, False))


add("expire_sessions", lambda s, d: ups.expire_sessions(_two_runs(s, d), ["user_pseudo_id", "session_id"], 12).select(
    "user_pseudo_id", "session_id", "event_timestamp"), with_base(f"""
SELECT user_pseudo_id, sid AS session_id, {clock('newest')} AS event_timestamp FROM (
  SELECT user_pseudo_id, sid, max(event_timestamp) AS newest FROM hx GROUP BY ALL)
WHERE newest >= (SELECT max(event_timestamp) FROM hx) - INTERVAL 12 DAY""", etl._SM))


def _recomputed(s, d):
    """Totals of the users seen on one day, written over those of the whole table, twice."""
    whole = b.events(s, d)
    keys = ["app_id", "user_id", "user_pseudo_id"]
    stale = behaviour.user_behavior(until(whole, MID))
    batch = whole.where(F.to_date("event_timestamp") == F.lit(MID))
    fresh = behaviour.user_behavior_of(until(whole, dt.date(2024, 1, 16)), batch)
    return ups.upsert(ups.upsert(stale, fresh, keys), fresh, keys)


add("user_behavior_recompute", _recomputed, with_base(f"""
SELECT app_id, user_id, user_pseudo_id, {day('min(event_date)')} AS first_visit_date, {day('max(event_date)')} AS last_visit_date,
  count(DISTINCT session_id) AS total_sessions, count(*) AS total_events, round(sum(coalesce(event_value, 0)), 8) AS ltv
FROM ev WHERE event_timestamp < TIMESTAMP '2024-01-16' GROUP BY ALL"""))
