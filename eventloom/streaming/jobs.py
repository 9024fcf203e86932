"""The batch rules as Structured Streaming jobs.

Sources and sinks are parameters: a file stream and a message stream differ only
in the reader. Every job takes its checkpoint folder and runs until stopped, or
once over what is there with `available_now`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.names import FIRST_OPEN, FIRST_VISIT, PROFILE_SET, VIEW_EVENTS
from eventloom.operators import sessions, tables
from eventloom.operators.dedupe import keep_one
from eventloom.session import send_package
from eventloom.sources.partials import PartialLog
from eventloom.sources.raw import PARTITIONS, RAW_SCHEMA
from eventloom.streaming.users import PICTURE, UserPicture

LATE = "72 hours"
ALWAYS = [FIRST_OPEN, FIRST_VISIT, PROFILE_SET]


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Uploads from a topic whose values are the JSON of an upload; needs the connector on the class path."""
    rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return rows.select(F.from_json(F.col("value").cast("string"), RAW_SCHEMA).alias("u")).select("u.*")


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ingest(uploads: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Uploads into hour folders of JSON lines, exactly once."""
    at = F.timestamp_millis("ingest_time")
    rows = uploads.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour_of_day": F.hour(at)})
    return _start(rows.writeStream.format("json").partitionBy(*PARTITIONS).option("path", path), checkpoint, available_now)


def _age() -> Column:
    return F.col("ingest_time_msec") - F.col("event_time_msec")


def late_branches(events: DataFrame, now=None) -> tuple[DataFrame, DataFrame]:
    """Events in time, and the three names that always pass.

    Events more than 72 hours older than their ingest, and future ones, are dropped by a test of two columns of the
    row, without state. What passed has a watermark on event time for later stateful steps. Events of the three names
    are a branch of their own, whose clock is the ingest: a later step holds its state as long, but never finds one late.
    """
    now = F.current_timestamp() if now is None else now
    always = F.col("event_name").isin(ALWAYS)
    in_time = events.where(~always & (F.col("event_timestamp") <= now) & (_age() <= 72 * 3_600_000))
    return (in_time.withWatermark("event_timestamp", LATE),
            events.where(always).withColumn("ingested_at", F.timestamp_millis("ingest_time_msec")).withWatermark("ingested_at", LATE))


def late_filter(events: DataFrame, now=None) -> DataFrame:
    """Both branches as one stream of rows, for steps without state."""
    in_time, always = late_branches(events, now)
    return in_time.unionByName(always.drop("ingested_at"))


def late_dedupe(events: DataFrame, now=None) -> DataFrame:
    """Both branches without repeats of (event id, event time), each under its own clock."""
    in_time, always = late_branches(events, now)
    keys = ["event_id", "event_timestamp"]
    return in_time.dropDuplicatesWithinWatermark(keys).unionByName(always.dropDuplicatesWithinWatermark(keys).drop("ingested_at"))


def hourly_counts(events: DataFrame) -> DataFrame:
    """Events, views and users per hour, exact: a window with one row per user feeds a second one that counts them.

    The state is one row per (hour, user) until the watermark passes the hour; a very active user is one row.
    """
    names = ["app_id", "event_name", "platform"]
    per_user = events.groupBy(F.window("event_timestamp", "1 hour"), *names, "user_pseudo_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_name").isin(VIEW_EVENTS)).alias("views"))
    return per_user.groupBy(F.window(F.window_time("window"), "1 hour"), *names).agg(
        F.sum("events").alias("event_count"), F.sum("views").alias("view_count"), F.count("user_pseudo_id").alias("user_count"),
    ).select(F.col("window.start").alias("event_hour"), *names, "event_count", "view_count", "user_count")


def hourly_users(events: DataFrame) -> DataFrame:
    """Exact (hour, platform, user) rows: each is kept as state until the watermark passes its hour."""
    hour = F.date_trunc("hour", "event_timestamp")
    return events.withColumn("event_hour", hour).select("event_hour", "app_id", "platform", "user_pseudo_id",
                                                        "event_timestamp").withWatermark(
        "event_hour", LATE).dropDuplicates(["event_hour", "app_id", "platform", "user_pseudo_id"]).select(
        "event_hour", "app_id", "platform", "user_pseudo_id")


def dedupe(events: DataFrame) -> DataFrame:
    """Drops repeats of (event id, event time) that arrive within the watermark."""
    return events.dropDuplicatesWithinWatermark(["event_id", "event_timestamp"])


def gap_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Bursts of a user: sessions that end after `gap` without an event."""
    return events.groupBy(F.session_window("event_timestamp", gap), "app_id", "user_pseudo_id").agg(
        F.count(F.lit(1)).alias("events")).select(
        "app_id", "user_pseudo_id", F.col("session_window.start").alias("start"),
        F.col("session_window.end").alias("end"), "events")


def _foreach(rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    return _start(rows.writeStream.foreachBatch(apply), checkpoint, available_now)


def user_log(spark: SparkSession, path: str, schema: T.StructType) -> PartialLog:
    """The table of `user_state`: partial rows, which merge in any order and grouping."""
    return PartialLog(spark, path, schema, lambda rows: tables.merge_users(rows).withColumn("batch", F.lit(0).cast("long")))


def user_state(parsed: DataFrame, target: PartialLog, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """One partial row per user and batch; a read merges them (`finish_users` makes the stored columns)."""
    return _foreach(parsed, lambda batch, number: target.append(tables.partial_users(tables.user_rows(batch)), number), checkpoint, available_now)


def session_log(spark: SparkSession, path: str, schema: T.StructType) -> PartialLog:
    """The table of `session_merge`: rows by batch, folded by the precedence of the batch merge."""
    return PartialLog(spark, path, schema, sessions.fold_batches)


def session_merge(events: DataFrame, target: PartialLog, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Session rows of each batch; which of them stands for a session is decided when they are read."""
    return _foreach(events, lambda batch, number: target.append(sessions.best_in_batch(sessions.extract_sessions(batch)), number),
                    checkpoint, available_now)


def users_with_ttl(parsed: DataFrame, keep: dt.timedelta) -> DataFrame:
    """The picture of each user seen in a batch, from state that ends `keep` after the user's last event.

    Keyed state with one row per user and an event-time timer; a batch touches its own users only, and the checkpoint
    carries the state over a restart. Rows come out as stored user columns with a `version`; the last one of a user by
    (event_timestamp, version) is the current one (`current_users`). An event more than `keep` after the last one finds
    no state, whether or not the timer has fired: the picture starts anew.
    """
    spark = parsed.sparkSession
    send_package(spark)
    # Timers need this store; a query keeps the one it was started with.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = tables.user_rows(parsed).where(F.col("user_pseudo_id").isNotNull())
    told = tables.partial_rows(rows)
    kinds = {c: told.schema[c].dataType for c in ("process_info", "first", "latest")}
    wide = told.select(*tables.USER_KEYS, F.unix_micros("event_timestamp").alias("at"), "user_id", F.to_json("process_info").alias("info"), F.col("info_at.event_id").alias("event_id"),
                       F.to_json("first").alias("first"), F.to_json("latest").alias("latest"))
    made = wide.groupBy(*tables.USER_KEYS).transformWithState(
        UserPicture(keep), T._parse_datatype_string(f"app_id string, user_pseudo_id string, {PICTURE}"), "Append", "EventTime")
    return tables.finish_users(made.select(
        *tables.USER_KEYS, F.timestamp_micros("seen").alias("event_timestamp"), "user_id", F.from_json("info", kinds["process_info"]).alias("process_info"),
        F.from_json("first", kinds["first"]).alias("first"), F.from_json("latest", kinds["latest"]).alias("latest"), "version"), "version")


def current_users(changes: DataFrame) -> DataFrame:
    """Of all pictures that `users_with_ttl` has put out, the last one of each user."""
    return keep_one(changes, tables.USER_KEYS, ["event_timestamp", "version"]).drop("version")
