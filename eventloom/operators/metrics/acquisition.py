"""New users, sessions and engagement by where the traffic came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.names import FIRST_OPEN
from eventloom.operators.metrics.common import daily, engaged, engagement_sum, is_event, is_view, ratio, stack
from eventloom.session import staged


# Rows that a task stacks at most, if no user has more of one day: each becomes up to 13.
ROWS_PER_TASK = 50_000
SUMS = ["new_user_count", "session_count", "engaged_session_count", "event_count", "total_engagement_time_msec"]


def _dealt(rows: DataFrame, user: str) -> DataFrame:
    """The rows written once and dealt by user and day to as many tasks as their number asks for.

    What is grouped by user and day after them is then in one task only, and no task holds more groups where the table is larger.
    """
    rows = staged(rows, "acquisition")
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))
    return rows.repartition(parts, "app_id", "event_date", "platform", user)


def _totals(sessions: DataFrame, user: str, columns: list[str], dims: list, users: DataFrame | None = None) -> DataFrame:
    """Totals per day, dimension, platform and user, from sessions that hold the dimensions' `columns` or get them from `users`.

    Sessions are summed per user and day first; those sums are stacked.
    """
    hit, keys = F.col("session_indicator") == 1, ["app_id", "event_date", "platform", user]
    whole = sessions.groupBy(*keys, *columns).agg(
        F.sum("new_user_indicator").alias("new_user_count"),
        F.count("session_id").alias("session_count"),
        F.sum("session_indicator").alias("engaged_session_count"),
        F.sum("event_count").alias("event_count"),
        F.sum(F.when(hit, F.col("_msec")).otherwise(0)).alias("total_engagement_time_msec"),
    )
    rows = stack(_dealt(whole if users is None else whole.join(users, user, "left"), user), dims, keep_nulls=True)
    return rows.groupBy("app_id", "event_date", "aggregation_type", "aggregation_dim", "platform", user).agg(
        *[F.sum(c).alias(c) for c in SUMS],
    ).withColumn(
        # Engaged sessions over events, as the metric's name has always meant here.
        "engagement_rate", F.coalesce(ratio(F.col("engaged_session_count"), F.col("event_count")), F.lit(0.0)),
    ).withColumn(
        "engaged_session_rate",
        F.coalesce(ratio(F.col("engaged_session_count"), F.col("session_count")), F.lit(0.0)),
    ).withColumn(
        "avg_engagement_time_seconds",
        F.coalesce(ratio(F.col("total_engagement_time_msec"), F.col("engaged_session_count")) / 1000, F.lit(0.0)),
    )


def _pair(kind: str, left: str, right: str, skip_nulls: bool):
    joined = (F.concat_ws(" / ", left, right) if skip_nulls
              else F.concat(F.col(left), F.lit(" / "), F.col(right)))
    return (kind, joined, None)


FIRST_COLUMNS = [
    "first_traffic_source", "first_traffic_medium", "first_traffic_campaign",
    "first_traffic_clid_platform", "first_traffic_channel_group", "first_app_install_source",
]


def acquisition(view: DataFrame, users: DataFrame) -> DataFrame:
    """By 11 traffic dimensions per device user.

    Events are reduced to sessions first; the 11-fold stack works on sessions.
    """
    source = ["traffic_source_source", "traffic_source_medium", "traffic_source_campaign",
              "traffic_source_clid_platform", "traffic_source_channel_group"]
    sessions = (
        daily(view)
        .groupBy("app_id", "event_date", "platform", "session_id", "user_pseudo_id", *source)
        .agg(
            F.countDistinct("event_id").alias("event_count"),
            F.sum(F.when(is_view(), 1).otherwise(0)).alias("_views"),
            F.max("session_duration").alias("_duration"),
            engagement_sum().alias("_msec"),
            F.max(F.when(is_event(FIRST_OPEN), 1).otherwise(0)).alias("new_user_indicator"),
        )
        .withColumn("session_indicator", engaged("_views", "_duration"))
    )
    first = users.select("user_pseudo_id", *FIRST_COLUMNS, F.lit(True).alias("_known"))
    known = F.col("_known").isNotNull()
    dims = [
        ("Session Traffic Source", F.col("traffic_source_source"), None),
        ("Session Traffic Medium", F.col("traffic_source_medium"), None),
        _pair("Session Traffic Source / Medium", "traffic_source_source", "traffic_source_medium", True),
        ("Session Traffic Campaign", F.col("traffic_source_campaign"), None),
        ("Session Traffic Channel Group", F.col("traffic_source_channel_group"), None),
        ("User First Traffic Source", F.col("first_traffic_source"), known),
        ("User First Traffic Medium", F.col("first_traffic_medium"), known),
        (*_pair("User First Traffic Source / Medium", "first_traffic_source", "first_traffic_medium", True)[:2], known),
        ("User First Traffic Campaign", F.col("first_traffic_campaign"), known),
        ("User First Traffic Channel Group", F.col("first_traffic_channel_group"), known),
        ("App First Install Source", F.col("first_app_install_source"), known),
    ]
    return _totals(sessions, "user_pseudo_id", source, dims, first)


# The 13 dimensions by label. Fixed values.
def _dims_13(first_only=None) -> list:
    f = first_only
    return [
        ("User First Traffic Source", F.col("first_traffic_source"), f),
        (*_pair("User First Traffic Source / Medium", "first_traffic_source", "first_traffic_medium", False)[:2], f),
        ("User First Traffic Medium", F.col("first_traffic_medium"), f),
        ("User First Traffic Campaign", F.col("first_traffic_campaign"), f),
        ("User First Traffic Clid Platform", F.col("first_traffic_clid_platform"), f),
        ("User First Traffic Channel Group", F.col("first_traffic_channel_group"), f),
        ("App First Install Source", F.col("first_app_install_source"), f),
        ("Session Traffic Source", F.col("session_source"), None),
        ("Session Traffic Medium", F.col("session_medium"), None),
        _pair("Session Traffic Source / Medium", "session_source", "session_medium", False),
        ("Session Traffic Campaign", F.col("session_campaign"), None),
        ("Session Traffic Clid Platform", F.col("session_clid_platform"), None),
        ("Session Traffic Channel Group", F.col("session_channel_group"), None),
    ]


SESSION_COLUMNS = ["session_source", "session_medium", "session_campaign",
                   "session_clid_platform", "session_channel_group"]


def acquisition_tz(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """By 13 dimensions per merged user, on local days.

    Session totals ignore the platform; a session seen on two platforms counts
    in full on each. Both levels come from one pass: totals per (session,
    platform) first, then a window over the few platforms of a session. An event
    belongs to one platform, so distinct events add up.
    """
    keys = ["app_id", "event_date", "merged_user_id", "session_id"]
    parts = daily(view, tz).groupBy(*keys, "platform").agg(
        F.countDistinct("event_id").alias("event_count"),
        F.sum(F.when(is_view(), 1).otherwise(0)).alias("_views"),
        F.max("session_duration").alias("_duration"),
        F.sum("user_engagement_time_msec").alias("_msec"),
        F.max(F.when(is_event(FIRST_OPEN), 1).otherwise(0)).alias("new_user_indicator"),
        *[F.max(c).alias(c) for c in FIRST_COLUMNS + SESSION_COLUMNS],
    )
    w = Window.partitionBy(*keys)
    whole = parts
    for name, fn in [("event_count", F.sum), ("_views", F.sum), ("_duration", F.max),
                     ("_msec", F.sum), ("new_user_indicator", F.max)]:
        whole = whole.withColumn(name, fn(name).over(w))
    hit = (engaged("_views", "_duration") == 1) | (F.coalesce(F.col("_msec"), F.lit(0)) > 10_000_000)
    out = _totals(whole.withColumn("session_indicator", F.when(hit, 1).otherwise(0)), "merged_user_id",
                  FIRST_COLUMNS + SESSION_COLUMNS, _dims_13())
    return out.select(
        "app_id", "event_date", "aggregation_type", "aggregation_dim", "platform",
        F.col("merged_user_id").alias("user_id"), "new_user_count", "session_count",
        F.col("engaged_session_count").alias("engagement_session_count"), "engagement_rate",
        "engaged_session_rate",
        (F.col("total_engagement_time_msec") / 1000).alias("total_user_engagement_time_seconds"),
        (F.col("total_engagement_time_msec") / 1000 / F.greatest(F.col("engaged_session_count"), F.lit(1)))
        .alias("avg_user_engagement_time_seconds"),
        "event_count",
    )


def traffic_users(view: DataFrame, tz: str = "UTC") -> DataFrame:
    """Distinct users per source; the first-touch dimensions only on a first open."""
    rows = stack(
        _dealt(daily(view, tz).select("app_id", "event_date", "platform", "event_name", "merged_user_id",
                                      *FIRST_COLUMNS, *SESSION_COLUMNS).distinct(), "merged_user_id"),
        _dims_13(is_event(FIRST_OPEN)), keep_nulls=True)
    return rows.select("app_id", "event_date", "platform", "aggregation_type", "aggregation_dim",
                       F.col("merged_user_id").alias("user_id")).distinct()
