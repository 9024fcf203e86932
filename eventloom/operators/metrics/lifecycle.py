"""Weekly users and their state: new, retained, returned, churned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.timeunits import local
from eventloom.names import SESSION_START
from eventloom.operators.metrics.common import is_event


def _weeks(view: DataFrame, tz: str) -> DataFrame:
    week = F.date_trunc("week", local("event_timestamp", tz)).cast("date")
    return view.where(is_event(SESSION_START)).withColumn("time_period_week", week)


def lifecycle_weekly(view: DataFrame) -> DataFrame:
    return _weeks(view, "UTC").groupBy("app_id", "time_period_week", "platform").agg(
        F.countDistinct("user_pseudo_id").alias("user_count"))


def lifecycle_state(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """Users per week and state; a churned user counts negatively in the week after.

    Weeks are distinct per user before the window, so a user contributes at most
    one row per week and platform. Neighbouring weeks ignore the platform.
    """
    weeks = _weeks(view, tz).select("app_id", "user_pseudo_id", "platform", "time_period_week").distinct()
    w = Window.partitionBy("app_id", "user_pseudo_id").orderBy("time_period_week", "platform")
    gap = F.datediff("time_period_week", F.lag("time_period_week").over(w)) / 7
    ahead = F.datediff(F.lead("time_period_week").over(w), F.col("time_period_week")) / 7
    rows = weeks.select("*", gap.alias("_gap"), ahead.alias("_ahead")).select(
        "app_id", "platform", "time_period_week",
        F.when(F.col("_gap").isNull(), "1-NEW").when(F.col("_gap") == 1, "2-RETAINED-ACTIVE")
        .when(F.col("_gap") > 1, "3-RETURN").alias("state"),
        F.coalesce(F.col("_ahead") != 1, F.lit(True)).alias("_churn"),
    )
    here = F.struct(F.col("time_period_week").alias("time_period"), F.col("state").alias("this_week_value"),
                    F.lit(1).alias("n"))
    gone = F.when(F.col("_churn"), F.struct(
        F.date_add("time_period_week", 7).alias("time_period"), F.lit("0-CHURN").alias("this_week_value"),
        F.lit(-1).alias("n")))
    return (
        rows.select("app_id", "platform", F.explode(F.array_compact(F.array(here, gone))).alias("e"))
        .groupBy("app_id", "e.time_period", "platform", "e.this_week_value")
        .agg(F.sum("e.n").alias("sum"))
    )
