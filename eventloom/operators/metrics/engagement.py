"""Session quality and the engagement indicators built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.metrics.common import daily, engaged, engagement_sum, is_view, ratio


def session_analysis(view: DataFrame) -> DataFrame:
    """One row per session and day. Duration falls back to whole seconds between first and last event."""
    span = (F.unix_timestamp("session_end_time") - F.unix_timestamp("session_start_time")) * 1000
    return (
        daily(view)
        .groupBy("app_id", "session_id", "user_pseudo_id", "platform", "event_date")
        .agg(
            F.min("event_timestamp").alias("session_start_time"),
            F.max("event_timestamp").alias("session_end_time"),
            F.count(F.lit(1)).alias("events_count"),
            F.count_if(is_view()).alias("view_count"),
            engagement_sum().alias("user_engagement_time_msec"),
            F.max("session_duration").alias("session_duration"),
        )
        .withColumn("session_duration", F.coalesce(F.col("session_duration"), span))
        .withColumn("engaged_session", engaged("view_count", "session_duration"))
        .withColumn("bounce_flag", F.col("engaged_session") == 0)
    )


def _sessions(days: DataFrame, user: str) -> DataFrame:
    return (
        days.groupBy("app_id", "event_date", "platform", "session_id", user)
        .agg(
            engagement_sum().alias("_msec"),
            F.count_if(is_view()).alias("_views"),
            F.max("session_duration").alias("_duration"),
        )
        .withColumn("_engaged", engaged("_views", "_duration"))
    )


def engagement_kpi(view: DataFrame) -> DataFrame:
    """Engaged sessions and engagement time per day, by device user."""
    totals = _sessions(daily(view), "user_pseudo_id").groupBy("app_id", "event_date", "platform").agg(
        F.countDistinct("user_pseudo_id").alias("total_users"),
        F.sum("_engaged").alias("engaged_sessions"),
        F.sum(F.when(F.col("_engaged") == 1, F.col("_msec")).otherwise(0)).alias("total_engagement_time_msec"),
    )
    msec, sessions, users = (F.col(c) for c in
                             ("total_engagement_time_msec", "engaged_sessions", "total_users"))
    return totals.select(
        "*",
        ratio(sessions, users).alias("avg_engaged_session_per_user"),
        F.coalesce(ratio(msec, sessions) / 1000, F.lit(0.0)).alias("avg_engagement_time_per_session_seconds"),
        (ratio(msec, users) / 1000).alias("avg_engagement_time_per_user_seconds"),
    )


def engagement_kpi_tz(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """The same by merged user, on days of a zone; every day of the input in one pass."""
    totals = _sessions(daily(view, tz), "merged_user_id").groupBy("app_id", "event_date", "platform").agg(
        F.countDistinct("merged_user_id").alias("users"),
        F.sum("_engaged").alias("sessions"),
        F.sum(F.when(F.col("_engaged") == 1, F.col("_msec")).otherwise(0)).alias("msec"),
    )
    msec = F.col("msec").cast("double")
    return totals.select(
        "app_id", "event_date", "platform",
        ratio(F.col("sessions"), F.col("users")).alias("avg_engaged_session_per_user"),
        (msec / F.greatest(F.col("sessions"), F.lit(1)) / 1000).alias("avg_engagement_time_per_session_seconds"),
        (msec / F.col("users") / 1000).alias("avg_engagement_time_per_user_seconds"),
    )
