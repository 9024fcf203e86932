"""Counts of events, views and users over time.

`countDistinct` aggregates partially on (keys, value) before it counts, so a key
with a large share of all rows is spread over every reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.timeunits import local, local_date, msec_date
from eventloom.names import FIRST_OPEN
from eventloom.operators.metrics.common import daily, is_event, is_view


def _summary(df: DataFrame, *keys: str) -> DataFrame:
    """Exact counts of events, users and sessions, with no row multiplied per count.

    Events are one distinct count; users and sessions are counted over their distinct pairs, which are few after the
    partial step. The event name is one of the keys, so a group's views are all of its events or none.
    """
    events = df.groupBy(*keys).agg(F.countDistinct("event_id").alias("event_count"))
    people = df.select(*keys, "user_pseudo_id", "session_id").distinct().groupBy(*keys).agg(
        F.countDistinct("user_pseudo_id").alias("user_count"), F.countDistinct("session_id").alias("session_count"))
    counts = ["event_count", "user_count", "session_count"]
    halves = [half.select(*keys, *[F.col(c) if c in half.columns else F.lit(0).cast("long").alias(c) for c in counts]) for half in (events, people)]
    views = F.when(is_view(), F.col("event_count")).otherwise(F.lit(0))
    return halves[0].unionByName(halves[1]).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts]).withColumn("view_count", views.cast("bigint"))


def event_daily(view: DataFrame) -> DataFrame:
    return _summary(daily(view), "app_id", "event_date", "event_name", "platform", "geo_country")


def event_hourly(view: DataFrame) -> DataFrame:
    hourly = view.withColumn("event_hour", F.date_trunc("hour", "event_timestamp"))
    return _summary(hourly, "app_id", "event_hour", "event_name", "platform", "geo_country")


def _active(view: DataFrame, label: str, unit: str) -> DataFrame:
    start = F.date_trunc(unit, F.col("event_timestamp")).cast("date")
    return view.groupBy("app_id", start.alias(label), "platform").agg(
        F.countDistinct("user_pseudo_id").alias("user_count"))


def dau(view: DataFrame) -> DataFrame:
    return _active(view, "event_date", "day")


def wau(view: DataFrame) -> DataFrame:
    """Users per Monday week. Pass whole weeks: a week is recounted, never topped up."""
    return _active(view, "week_start", "week")


def mau(view: DataFrame) -> DataFrame:
    return _active(view, "month_start", "month")


def active_user_list(view: DataFrame, tz: str = "UTC") -> DataFrame:
    return daily(view, tz).select("app_id", "event_date", "platform", "merged_user_id").distinct()


def new_return(view: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """New or returning users per day: first touch day, or a first-open event where no users are given."""
    days = daily(view)
    keys = ["app_id", "event_date", "platform"]
    if users is None:
        per_user = days.groupBy(*keys, "user_pseudo_id").agg(
            F.max(F.when(is_event(FIRST_OPEN), 1).otherwise(0)).alias("_new"))
        is_new = F.col("_new") == 1
    else:
        touch = users.select("user_pseudo_id", msec_date("first_touch_time_msec").alias("_first"))
        per_user = days.select(*keys, "user_pseudo_id").distinct().join(touch, "user_pseudo_id")
        is_new = F.col("event_date") == F.col("_first")
    kind = F.when(is_new, F.lit("NEW")).otherwise(F.lit("RETURNING")).alias("user_type")
    return per_user.groupBy(*keys, kind).agg(F.countDistinct("user_pseudo_id").alias("user_count"))


def new_return_tz(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """The same by merged user and in a zone; `view` carries first_touch_time_msec."""
    is_new = F.col("event_date") == msec_date("first_touch_time_msec", tz)
    kind = F.when(is_new, F.lit("NEW")).otherwise(F.lit("RETURNING")).alias("user_type")
    return daily(view, tz).groupBy("app_id", "event_date", "platform", kind).agg(
        F.countDistinct("merged_user_id").alias("user_count"))


def user_view_count(view: DataFrame, tz: str = "UTC") -> DataFrame:
    return daily(view, tz).groupBy(
        "app_id", "event_date", "platform", F.col("merged_user_id").alias("active_users"),
    ).agg(
        F.countDistinct(F.when(is_event(FIRST_OPEN), F.col("user_pseudo_id"))).alias("new_users"),
        F.countDistinct(F.when(is_view(), F.col("event_id"))).alias("view_count"),
    )


def intraday_users(view: DataFrame, tz: str = "UTC") -> DataFrame:
    return view.select(
        "app_id",
        F.date_trunc("hour", local("event_timestamp", tz)).alias("event_date"),
        "platform",
        F.col("merged_user_id").alias("active_users"),
        F.when(is_event(FIRST_OPEN), F.col("merged_user_id")).alias("new_users"),
    ).distinct()


def day_event_view(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """Distinct events first, then one count: no row is multiplied per distinct column."""
    keys = ["app_id", "event_date", "platform"]
    once = daily(view, tz).groupBy(*keys, "event_id").agg(F.max(F.when(is_view(), 1).otherwise(0)).alias("_view"))
    return once.groupBy(*keys).agg(F.count("event_id").alias("event_count"), F.sum("_view").alias("view_count"))


def event_overtime(view: DataFrame, tz: str = "UTC") -> DataFrame:
    return view.groupBy("app_id", local_date("event_timestamp", tz).alias("event_date"), "platform").agg(
        F.countDistinct("event_id").alias("event_count"))
