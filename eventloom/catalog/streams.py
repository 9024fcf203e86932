"""Streaming jobs run once over files derived from the tables; the oracle is the batch answer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import uploads as up
from eventloom.adapt import with_duplicates
from eventloom.catalog import base as b
from eventloom.catalog import etl
from eventloom.catalog.base import clock, with_base
from eventloom.names import TRAFFIC_FIELDS
from eventloom.operators import sessions, tables
from eventloom.session import scratch
from eventloom.sources.raw import PARTITIONS, RAW_SCHEMA
from eventloom.streaming import jobs

QUERIES: dict[str, b.Query] = {}
ORACLES: dict[str, str] = {}


def add(key: str, fn: b.Query, sql: str | None = None) -> None:
    QUERIES[key] = b.query(fn)
    if sql is not None:
        ORACLES[key] = sql


def _stream(s, rows, files: int = 4):
    """The rows as a file stream of several batches, oldest first."""
    path = scratch(s, "source")
    rows.repartitionByRange(files, "event_timestamp").write.parquet(path)
    return jobs.file_stream(s, path, rows.schema, files_per_batch=2)


def _periods(rows, column: str, cuts: list[str]):
    """The rows of each period between the cuts (dates), in their order."""
    at = F.col(column)
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        held = F.lit(True)
        for cut, test in ((low, at.__ge__), (high, at.__lt__)):
            held = held if cut is None else held & test(F.lit(cut).cast("timestamp"))
        yield rows.where(held)


def _in_order(s, rows, column: str, cuts: list[str]):
    """The rows as a file stream of one batch per period."""
    path = scratch(s, "periods")
    for period in _periods(rows, column, cuts):
        period.coalesce(1).write.mode("append").parquet(path)
    return jobs.file_stream(s, path, rows.schema, files_per_batch=1)


def _in_runs(s, rows, column: str, cuts: list[str], job):
    """What a job puts out for the periods, each of which is one batch: a run takes all files that have come, however
    many tasks wrote them, and the next one goes on from its checkpoint."""
    path, out, check = scratch(s, "periods"), scratch(s, "out"), scratch(s, "check")
    for period in _periods(rows, column, cuts):
        period.write.mode("append").parquet(path)
        made = job(jobs.file_stream(s, path, rows.schema))
        jobs._start(made.writeStream.format("parquet").outputMode("append").option("path", out), check, True).awaitTermination()
    return s.read.schema(made.schema).parquet(out)


def _finish(s, df, mode: str = "append"):
    """Runs a stateful stream over everything there is and reads what it emitted."""
    out, check = scratch(s, "out"), scratch(s, "check")
    jobs._start(df.writeStream.format("parquet").outputMode(mode).option("path", out), check, True).awaitTermination()
    return s.read.schema(df.schema).parquet(out)


def _closing(rows):
    """One row far in the future, whose only effect is to move the watermark past all others."""
    last = rows.orderBy(F.desc("event_timestamp"), F.desc("event_id")).limit(1)
    return rows.unionByName(last.withColumns({
        "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 60 DAYS"), "event_id": F.lit("closing"),
        "user_pseudo_id": F.lit("closing"), "app_id": F.lit("closing")}))


def _ingest(s, d):
    rows = up.sdk_uploads(s, d).select(*[F.col(f.name).cast(f.dataType) if f.name != "_corrupt_record" else F.lit(None).cast("string").alias(f.name)
                                         for f in T._parse_datatype_string(RAW_SCHEMA).fields])
    source, out = scratch(s, "uploads"), scratch(s, "hours")
    rows.repartition(4).write.json(source)
    jobs.ingest(jobs.file_stream(s, source, RAW_SCHEMA, "json"), out, scratch(s, "check"), True).awaitTermination()
    folders = ", ".join(f"{p} int" for p in PARTITIONS)
    return s.read.schema(f"rid string, ingest_time bigint, {folders}").json(out).groupBy(*PARTITIONS).agg(
        F.count("rid").alias("uploads"))


add("stream_ingest", _ingest, etl.sql("""
SELECT CAST(year(t) AS BIGINT) AS year, CAST(month(t) AS BIGINT) AS month, CAST(day(t) AS BIGINT) AS day, CAST(hour(t) AS BIGINT) AS hour_of_day,
  count(*) AS uploads FROM (SELECT epoch_ms(max(ingest)) AS t FROM r1 GROUP BY b) GROUP BY ALL"""))


def _late(s, d):
    rows = b.events(s, d).select("event_id", "event_name", "event_timestamp", "event_time_msec",
                                 (F.col("event_time_msec") + F.col("custom_parameters")["k"]["value"].cast("long") * 3_600_000)
                                 .alias("ingest_time_msec"))
    now = F.lit("2024-01-20").cast("timestamp")
    return _finish(s, jobs.late_filter(_stream(s, rows), now)).select("event_id", "event_name")


add("stream_late", _late, with_base("""
SELECT event_id, event_name FROM ev WHERE event_name = '_first_open' OR (k <= 72 AND event_timestamp <= TIMESTAMP '2024-01-20')"""))


def _late_dedupe(s, d):
    """The days in order, then all first opens of the month once more: late for every watermark on event time."""
    rows = with_duplicates(b.events(s, d)).select("event_id", "event_name", "event_timestamp", "event_time_msec").withColumn("again", F.lit(0))
    ingest = F.greatest(F.col("event_time_msec"), F.col("again") * F.unix_millis(F.lit("2024-01-31").cast("timestamp")))
    first = rows.where("event_name = '_first_open'").withColumns({"again": F.lit(1), "event_id": F.concat("event_id", F.lit("-again"))})
    both = rows.unionByName(first).withColumn("ingest_time_msec", ingest)
    stream = _in_order(s, both.withColumn("ingested", F.timestamp_millis("ingest_time_msec")), "ingested", ["2024-01-10", "2024-01-20", "2024-01-31"])
    return _finish(s, jobs.late_dedupe(stream, F.lit("2024-02-20").cast("timestamp"))).select("event_id", "event_name")


add("stream_late_dedupe", _late_dedupe, with_base("""
SELECT event_id, event_name FROM ev UNION ALL SELECT event_id || '-again', event_name FROM ev WHERE event_name = '_first_open'"""))


def _small(s, d):
    return b.events(s, d).select("event_id", "event_name", "event_timestamp", "app_id", "platform", "user_pseudo_id")


add("stream_hourly", lambda s, d: _finish(s, jobs.hourly_counts(
    _stream(s, _closing(_small(s, d))).withWatermark("event_timestamp", jobs.LATE))).where("app_id <> 'closing'"), with_base(f"""
SELECT {clock("date_trunc('hour', event_timestamp)")} AS event_hour, app_id, event_name, platform, count(*) AS event_count,
  count(*) FILTER (event_name IN ('_page_view','_screen_view')) AS view_count, count(DISTINCT user_pseudo_id) AS user_count FROM ev GROUP BY ALL"""))
add("stream_hourly_users", lambda s, d: _finish(s, jobs.hourly_users(_stream(s, _small(s, d)))), with_base(f"""
SELECT DISTINCT {clock("date_trunc('hour', event_timestamp)")} AS event_hour, app_id, platform, user_pseudo_id FROM ev"""))


def _dupes(s, d):
    rows = with_duplicates(b.events(s, d)).select("event_id", "event_timestamp", "event_name")
    return _finish(s, jobs.dedupe(_stream(s, rows).withWatermark("event_timestamp", jobs.LATE)))


add("stream_dedupe", _dupes, with_base(f"""SELECT event_id, {clock('event_timestamp')} AS event_timestamp, event_name FROM ev"""))
add("stream_session_window", lambda s, d: _finish(s, jobs.gap_sessions(
    _stream(s, _closing(_small(s, d))).withWatermark("event_timestamp", jobs.LATE), "6 hours")).where("app_id <> 'closing'"), with_base(f"""
SELECT app_id, user_pseudo_id, {clock('min(event_timestamp)')} AS start, {clock('max(event_timestamp) + INTERVAL 6 HOUR')} AS "end", count(*) AS events
FROM (SELECT *, sum(CASE WHEN event_timestamp - before < INTERVAL 6 HOUR THEN 0 ELSE 1 END) OVER (
    PARTITION BY app_id, user_pseudo_id ORDER BY event_timestamp) AS g
  FROM (SELECT *, lag(event_timestamp) OVER (PARTITION BY app_id, user_pseudo_id ORDER BY event_timestamp) AS before FROM ev))
GROUP BY app_id, user_pseudo_id, g"""))


# What `user_rows` reads of a parsed event.
_USER_INPUT = [*tables.USER_KEYS, "event_timestamp", "event_id", "event_name", "user_id", "user_json", "user_first_touch_time_msec",
               "page_view_page_referrer", "page_view_latest_referrer", *[f"traffic_source_{f}" for f in TRAFFIC_FIELDS],
               "app_install_source", "process_info"]


def _parsed_stream(s, d):
    """Parsed events as a file stream of two batches, the older half first.

    They are parsed once before they are dealt, because dealing by ranges reads its input twice, and as many tasks write them as
    a shuffle has.
    """
    path, files = scratch(s, "parsed"), max(4, int(s.conf.get("spark.sql.shuffle.partitions")))
    rows = etl.stored(s, d, *_USER_INPUT)
    rows.repartitionByRange(files, "event_timestamp").write.parquet(path)
    return rows, jobs.file_stream(s, path, rows.schema, files_per_batch=(files + 1) // 2)


def _users(s, d):
    rows, stream = _parsed_stream(s, d)
    target = jobs.user_log(s, scratch(s, "state"), tables.partial_users(tables.user_rows(rows)).schema)
    jobs.user_state(stream, target, scratch(s, "check"), True).awaitTermination()
    target.compact()
    return etl._user_columns(tables.finish_users(target.read()))


add("stream_user_state", _users, etl.sql("SELECT * FROM uo", etl._USERS))


def _users_ttl(s, d):
    rows = etl.stored(s, d, *_USER_INPUT)
    made = _in_runs(s, rows, "event_timestamp", ["2024-01-08", "2024-01-15", "2024-01-22"],
                    lambda stream: jobs.users_with_ttl(stream.withWatermark("event_timestamp", jobs.LATE), dt.timedelta(hours=36)))
    return etl._user_columns(jobs.current_users(made))


# Events after a user's last pause of more than 36 hours.
_RECENT = """
pauses AS (SELECT *, em - lag(em) OVER (PARTITION BY app_id, user_pseudo_id ORDER BY em) > 129600000 AS anew FROM pe),
runs AS (SELECT *, count(*) FILTER (anew) OVER (PARTITION BY app_id, user_pseudo_id ORDER BY em RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  - CASE WHEN anew THEN 1 ELSE 0 END AS later FROM pauses),
recent AS (SELECT * FROM runs WHERE later = 0),"""
add("stream_user_ttl", _users_ttl, etl.sql("SELECT * FROM uo", _RECENT, etl._USERS.replace("FROM pe", "FROM recent")))


def _sessions(s, d):
    """Two batches: the first half of the month, then the second; sessions are weeks."""
    week = F.concat(F.col("user_pseudo_id"), F.lit("-"), F.date_format(F.date_trunc("week", "event_timestamp"), "yyyyMMdd"))
    rows = b.events(s, d).withColumn("session_id", week).drop("custom_parameters")
    cut = F.col("event_timestamp") < F.lit("2024-01-15 12:00:00").cast("timestamp")
    path = scratch(s, "halves")
    rows.where(cut).coalesce(1).write.parquet(f"{path}/half=1")
    rows.where(~cut).coalesce(1).write.parquet(f"{path}/half=2")
    target = jobs.session_log(s, scratch(s, "state"), sessions.extract_sessions(rows).schema)
    stream = jobs.file_stream(s, f"{path}/half=*", rows.schema, files_per_batch=1)
    jobs.session_merge(stream, target, scratch(s, "check"), True).awaitTermination()
    return target.read().select("user_pseudo_id", "session_id", "event_timestamp", "session_source", "session_medium")


add("stream_session_merge", _sessions, etl.ORACLES["merge_sessions"])
