"""The relation every analysis reads: events with their session and their user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.names import FIRST_OPEN, VIEW_EVENTS
from eventloom.operators.dedupe import dedupe_events
from eventloom.operators.sessions import SOURCE_FIELDS


def indicators(df: DataFrame) -> DataFrame:
    """Ids that count only on view events."""
    is_view = F.col("event_name").isin(VIEW_EVENTS)
    return df.withColumn("view_session_indicator", F.when(is_view, F.col("session_id"))).withColumn(
        "view_event_indicator", F.when(is_view, F.col("event_id")))


def base_view(events: DataFrame, sessions: DataFrame, created_after=None, unique: bool = False) -> DataFrame:
    """Deduplicated events with session columns.

    `created_after` narrows the scan to rows written since the last run (the
    incremental form). `unique` says that the events carry no repeats, which
    saves the shuffle of the dedupe step.
    """
    if created_after is not None:
        events = events.where(F.col("created_time") > F.lit(created_after))
    if not unique:
        events = dedupe_events(events)
    extra = [c for c in ("session_number", "session_start_time_msec") if c in sessions.columns]
    src = sessions.select("user_pseudo_id", "session_id", *extra, *SOURCE_FIELDS)
    return indicators(events.drop(*extra).join(src, ["user_pseudo_id", "session_id"], "left"))


def event_user_view(base: DataFrame, users: DataFrame) -> DataFrame:
    """Joins the user row; `merged_user_id` is the known id, else the device id."""
    drop = [c for c in users.columns if c in base.columns and c not in ("user_pseudo_id", "user_id")]
    u = users.drop(*drop).withColumnRenamed("user_id", "latest_user_id")
    merged = F.coalesce(F.col("latest_user_id"), F.col("user_pseudo_id"))
    first_day = F.to_date("event_timestamp") == F.col("first_visit_date")
    return (
        base.join(u, "user_pseudo_id")
        .withColumn("merged_user_id", merged)
        .withColumn("new_user_indicator", F.when(F.col("event_name") == FIRST_OPEN, merged))
        .withColumn("is_first_day_event", F.when(first_day, F.lit("true")).otherwise(F.lit("false")))
    )
