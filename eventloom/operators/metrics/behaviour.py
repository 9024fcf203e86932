"""Totals per user, per event name, per device, place and app version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.timeunits import local_date
from eventloom.names import APP_EXCEPTION, FIRST_OPEN
from eventloom.operators.metrics.common import daily, is_event


def user_behavior(view: DataFrame) -> DataFrame:
    return daily(view).groupBy("app_id", "user_id", "user_pseudo_id").agg(
        F.min("event_date").alias("first_visit_date"),
        F.max("event_date").alias("last_visit_date"),
        F.countDistinct("session_id").alias("total_sessions"),
        F.count(F.lit(1)).alias("total_events"),
        F.sum(F.coalesce(F.col("event_value"), F.lit(0.0))).alias("ltv"),
    )


def user_behavior_of(view: DataFrame, batch: DataFrame) -> DataFrame:
    """Totals of the users a batch touches, over all their events: repeatable, where adding up is not."""
    touched = batch.select("app_id", "user_pseudo_id").distinct()
    return user_behavior(view.join(touched, ["app_id", "user_pseudo_id"], "left_semi"))


def event_name(view: DataFrame, user: str = "user_pseudo_id", tz: str = "UTC") -> DataFrame:
    return daily(view, tz).groupBy(
        "app_id", "event_date", "platform", F.col(user).alias("user_id"), "event_name",
    ).agg(
        F.countDistinct("event_id").alias("event_count"),
        F.sum(F.coalesce(F.col("event_value"), F.lit(0.0))).alias("event_value"),
    )


def device_cols(df: DataFrame) -> DataFrame:
    """Display columns of the device: model, system, version, resolution."""
    size = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (
        df.withColumn("device", F.coalesce("device_mobile_model_name", "device_ua_device"))
        .withColumn("operating_system", F.coalesce("device_operating_system", "device_ua_os", F.lit("null")))
        .withColumn("operating_system_version",
                    F.coalesce("device_operating_system_version", "device_ua_os_version", F.lit("null")))
        .withColumn("device_screen_resolution",
                    F.concat(size("device_screen_width"), F.lit(" x "), size("device_screen_height")))
    )


DEVICE_COLUMNS = [
    "device", "app_version", "operating_system", "operating_system_version", "device_ua_browser",
    "device_screen_resolution", "device_ua_device", "device_ua_device_category",
]


def device_usage(view: DataFrame, user: str = "user_pseudo_id", tz: str = "UTC") -> DataFrame:
    return device_cols(daily(view, tz)).groupBy(
        "app_id", "event_date", F.col(user).alias("user_id"), "platform", *DEVICE_COLUMNS,
    ).agg(F.countDistinct("event_id").alias("event_count"))


def geo_new_user(view: DataFrame, tz: str = "UTC") -> DataFrame:
    return (
        view.where(is_event(FIRST_OPEN))
        .groupBy("app_id", local_date("event_timestamp", tz).alias("event_date"),
                 "platform", "geo_country", "geo_city")
        .agg(F.countDistinct("user_pseudo_id").alias("user_count"))
        .where("user_count > 0")
    )


def crash_rows(view: DataFrame, user: str = "user_pseudo_id", tz: str = "UTC") -> DataFrame:
    """Distinct user and version, with the user again when a crash was seen."""
    crashed = F.when(is_event(APP_EXCEPTION), F.col(user)).alias("crashed_user_id")
    return daily(view, tz).select(
        "app_id", "event_date", "platform", "app_version", F.col(user).alias("user_id"), crashed).distinct()


def crash_rate(rows: DataFrame) -> DataFrame:
    return rows.groupBy("app_id", "event_date", "platform", "app_version").agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("crashed_user_id").alias("crashed_users"),
    ).withColumn("crash_rate", F.col("crashed_users").cast("double") / F.col("users"))
