"""Cohort retention by day and by week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.timeunits import local_date, msec_date

# Reported by default.
MAX_DAYS = 42
MAX_WEEKS = 12


def _first_touch(view: DataFrame, users: DataFrame | None) -> DataFrame:
    if users is None:
        return view.groupBy("user_pseudo_id").agg(F.to_date(F.min("event_timestamp")).alias("first_date"))
    return users.where(F.col("first_touch_time_msec").isNotNull()).select(
        "user_pseudo_id", msec_date("first_touch_time_msec").alias("first_date"))


def _with_cohort(counts: DataFrame, keys: list[str], step: str) -> DataFrame:
    """Adds the cohort size, the count at step 0; cohorts without a step 0 drop out.

    The window holds at most one row per step, 43 or 13.
    """
    at_zero = F.max(F.when(F.col(step) == 0, F.col("retained_users"))).over(Window.partitionBy(*keys))
    return (
        counts.withColumn("cohort_users", at_zero)
        .where(F.col("cohort_users").isNotNull())
        .withColumn("retention_rate", F.col("retained_users").cast("double") / F.col("cohort_users"))
    )


def _drop_late(base: DataFrame, diff: str) -> DataFrame:
    """Drops (platform, user) pairs never seen on their first day.

    `base` holds distinct days of a user, at most 43 per app, so the window over
    one user is small whatever the user's number of events was.
    """
    seen = F.min(diff).over(Window.partitionBy("platform", "user_pseudo_id"))
    return base.withColumn("_least", seen).where(F.col("_least") <= 0).drop("_least")


def retention_daily(view: DataFrame, users: DataFrame | None = None, days: int = MAX_DAYS) -> DataFrame:
    active = view.select("app_id", "user_pseudo_id", "platform",
                         F.to_date("event_timestamp").alias("event_date")).distinct()
    base = (
        active.join(_first_touch(view, users), "user_pseudo_id")
        .withColumn("day_number", F.datediff("event_date", "first_date"))
        .where(F.col("day_number").between(0, days))
    )
    keys = ["app_id", "platform", "cohort_date"]
    counts = (
        _drop_late(base, "day_number")
        .groupBy("app_id", "platform", F.col("first_date").alias("cohort_date"), "day_number")
        .agg(F.countDistinct("user_pseudo_id").alias("retained_users"))
    )
    return _with_cohort(counts, keys, "day_number")


def _week(c: Column) -> Column:
    return F.date_trunc("week", c).cast("date")


def retention_weekly(view: DataFrame, users: DataFrame | None = None, weeks: int = MAX_WEEKS) -> DataFrame:
    active = view.select("app_id", "user_pseudo_id", "platform",
                         _week(F.col("event_timestamp")).alias("_active")).distinct()
    first = _first_touch(view, users).select("user_pseudo_id", _week(F.col("first_date")).alias("cohort_date"))
    counts = (
        active.join(first, "user_pseudo_id")
        .withColumn("week_number", F.floor(F.datediff("_active", "cohort_date") / 7).cast("int"))
        .where(F.col("week_number").between(0, weeks))
        .groupBy("app_id", "platform", "cohort_date", "week_number")
        .agg(F.countDistinct("user_pseudo_id").alias("retained_users"))
    )
    return _with_cohort(counts, ["app_id", "platform", "cohort_date"], "week_number")


def retention_base(view: DataFrame, tz: str = "UTC", days: int = MAX_DAYS) -> DataFrame:
    """Distinct user, platform, first day and day offset; `view` carries first_touch_time_msec."""
    first = F.timestamp_seconds(F.floor(F.col("first_touch_time_msec") / 1000))
    first_date = local_date(first, tz)
    return (
        view.where(F.col("first_touch_time_msec").isNotNull() & (F.col("event_timestamp") >= first))
        .select("app_id", "user_pseudo_id", "platform", first_date.alias("first_date"),
                F.datediff(local_date("event_timestamp", tz), first_date).alias("day_diff"))
        .where(F.col("day_diff") <= days)
        .distinct()
    )


def retention_view(base: DataFrame) -> DataFrame:
    """Returned and total users by first day, without users never seen on that day."""
    kept = _drop_late(base, "day_diff")
    keys = ["app_id", "platform", "first_date"]
    total = kept.groupBy(*keys).agg(F.countDistinct("user_pseudo_id").alias("total_users"))
    back = kept.groupBy(*keys, "day_diff").agg(F.countDistinct("user_pseudo_id").alias("returned_user_count"))
    return back.join(total, keys)
