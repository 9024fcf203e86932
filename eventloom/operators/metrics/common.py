"""Shared pieces of the metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.timeunits import local_date
from eventloom.names import VIEW_EVENTS


def is_view() -> Column:
    return F.col("event_name").isin(VIEW_EVENTS)


def is_event(name: str) -> Column:
    return F.col("event_name") == name


def daily(view: DataFrame, tz: str = "UTC") -> DataFrame:
    return view.withColumn("event_date", local_date("event_timestamp", tz))


def engagement_sum(condition: Column | None = None) -> Column:
    msec = F.coalesce(F.col("user_engagement_time_msec"), F.lit(0))
    return F.sum(msec if condition is None else F.when(condition, msec).otherwise(0))


def engaged(views: str, duration: str) -> Column:
    """1 for a session with more than one view or longer than ten seconds."""
    hit = (F.col(views) > 1) | (F.coalesce(F.col(duration), F.lit(0)) > 10_000)
    return F.when(hit, 1).otherwise(0)


def ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top.cast("double") / bottom)


def stack(df: DataFrame, dims: list[tuple[str, Column, Column | None]], keep_nulls: bool = False) -> DataFrame:
    """One row per (row, dimension): columns aggregation_type and aggregation_dim.

    Replaces a scan per dimension by one scan. `dims` holds (label, value,
    condition); a row skips the dimensions whose condition fails and, unless
    `keep_nulls`, those whose value is null. Skipped entries never leave the
    array, so nothing is generated for them.
    """
    entries = []
    for label, value, condition in dims:
        entry = F.struct(F.lit(label).alias("aggregation_type"), value.cast("string").alias("aggregation_dim"))
        keep = condition if condition is not None else F.lit(True)
        if not keep_nulls:
            keep = keep & value.isNotNull()
        entries.append(F.when(keep, entry))
    return df.withColumn("_dim", F.explode(F.array_compact(F.array(*entries)))).select(
        *df.columns, "_dim.aggregation_type", "_dim.aggregation_dim")
