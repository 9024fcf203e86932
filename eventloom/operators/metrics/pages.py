"""Views, entrances and exits by page title, URL path, screen name and screen class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.metrics.common import daily, is_event, is_view, stack

PAGE, SCREEN = "_page_view", "_screen_view"
# Label, column, the view event it belongs to. Fixed values.
DIMENSIONS = [
    ("Page Title", "page_view_page_title", PAGE),
    ("Page URL Path", "page_view_page_url_path", PAGE),
    ("Screen Name", "screen_view_screen_name", SCREEN),
    ("Screen Class", "screen_view_screen_id", SCREEN),
]
KEYS = ["app_id", "event_date", "platform", "aggregation_type", "aggregation_dim"]


def _dims(own_event: bool) -> list:
    return [(label, F.col(c), is_event(event) if own_event else None) for label, c, event in DIMENSIONS]


def page_view(view: DataFrame) -> DataFrame:
    rows = stack(daily(view.where(is_view())).select("app_id", "event_date", "platform", "event_id",
                                                     *[c for _, c, _ in DIMENSIONS]), _dims(False))
    return rows.groupBy(*KEYS).agg(F.countDistinct("event_id").alias("view_count"))


def _stack_all(view: DataFrame, tz: str, *columns: str) -> DataFrame:
    return stack(
        daily(view, tz).select("app_id", "event_date", "platform", "event_id", "event_name",
                               *columns, *[c for _, c, _ in DIMENSIONS]),
        _dims(False), keep_nulls=True)


def _own_view():
    own = F.when(F.col("aggregation_type").startswith("Page"), F.lit(PAGE)).otherwise(F.lit(SCREEN))
    return F.countDistinct(F.when(F.col("event_name") == own, F.col("event_id")))


def page_view_tz(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """Every event counts towards every dimension, null values included; only its own view event adds."""
    return _stack_all(view, tz).groupBy(*KEYS).agg(_own_view().alias("view_count"))


def page_view_detail(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """Events, own views and sessions per dimension and user, each exact.

    An event is one row per dimension, counted once by its id; sessions are counted over the distinct visits
    (user, session, dimensions), which are few before they are stacked. No row is multiplied per distinct count.
    """
    user = F.col("merged_user_id").alias("user_id")
    own = F.when(F.col("aggregation_type").startswith("Page"), F.lit(PAGE)).otherwise(F.lit(SCREEN))
    stacked = _stack_all(view, tz, "merged_user_id", "user_engagement_time_msec")
    once = stacked.groupBy(*KEYS, user, "event_id").agg(
        F.sum("user_engagement_time_msec").alias("_msec"), F.max(F.when(F.col("event_name") == own, 1).otherwise(0)).alias("_own"))
    events = once.groupBy(*KEYS, "user_id").agg(
        F.sum("_msec").alias("_msec"), F.count("event_id").alias("event_count"),
        F.sum(F.when(F.col("event_id").isNotNull(), F.col("_own")).otherwise(0)).alias("view_count"))
    visits = daily(view, tz).select("app_id", "event_date", "platform", user, "session_id", *[c for _, c, _ in DIMENSIONS]).distinct()
    sessions = stack(visits, _dims(False), keep_nulls=True).groupBy(*KEYS, "user_id").agg(F.countDistinct("session_id").alias("session_count"))
    both = events.unionByName(sessions, allowMissingColumns=True).groupBy(*KEYS, "user_id")
    return both.agg((F.sum("_msec").cast("double") / 1000).alias("user_engagement_time_seconds"),
                    *[F.sum(c).alias(c) for c in ("event_count", "view_count", "session_count")])


def entrance(view: DataFrame, tz: str = "UTC") -> DataFrame:
    first = view.where(is_view() & (F.col("page_view_entrances") == "true"))
    return stack(daily(first, tz), _dims(True)).groupBy(*KEYS).agg(
        F.countDistinct("event_id").alias("entrance_count"))


def exit_page(view: DataFrame) -> DataFrame:
    """The last view of each session, by its own dimensions."""
    cols = ["app_id", "platform", "event_name", "event_timestamp", *[c for _, c, _ in DIMENSIONS]]
    last = (
        view.where(is_view() & F.col("session_id").isNotNull()).groupBy("session_id")
        .agg(F.max_by(F.struct(*cols), F.struct("event_timestamp", "event_id")).alias("e"))
        .select("session_id", "e.*")
    )
    return stack(daily(last), _dims(True)).groupBy(*KEYS).agg(F.count("session_id").alias("exit_count"))


def exit_page_tz(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """The last value of each dimension within a session and local day."""
    rows = stack(daily(view.where(is_view()), tz), _dims(True))
    last = (
        rows.groupBy("session_id", "event_date", "aggregation_type")
        .agg(F.max_by(F.struct("app_id", "platform", "aggregation_dim"),
                      F.struct("event_timestamp", "event_id")).alias("e"))
        .select("event_date", "aggregation_type", "e.*")
    )
    return last.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("exit_count"))
