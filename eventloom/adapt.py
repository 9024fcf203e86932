"""The driver's `events` table seen as the flat event, user and session tables.

Only the mapping of the synthetic table lives here; every operator works on the
resulting columns and knows nothing about this file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.names import VIEW_EVENTS
from eventloom.operators.sessions import extract_sessions


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(selector: Column, values: list[str | None]) -> Column:
    out = None
    for i, value in enumerate(values):
        out = F.when(selector == i, F.lit(value)) if out is None else out.when(selector == i, F.lit(value))
    return out


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event; a pure projection of the scan, no shuffle."""
    u, kind = F.col("user_id"), F.col("event_type")
    base = raw_events(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    k = F.col("k")
    web = u % 3 == 0
    name = (
        F.when(kind == "view", F.when(web, F.lit("_page_view")).otherwise(F.lit("_screen_view")))
        .when(kind == "click", F.when(k % 2 == 0, F.lit("_session_start")).otherwise(F.lit("_click")))
        .when(kind == "signup", F.lit("_first_open"))
        .when(kind == "error", F.lit("_app_exception"))
        .otherwise(F.lit("purchase"))
    )
    page = (kind == "view") & web
    screen = (kind == "view") & ~web
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return base.select(
        text("e", F.col("event_id").cast("string")).alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        F.unix_millis("ts").alias("event_time_msec"),
        name.alias("event_name"),
        text("u", u.cast("string")).alias("user_pseudo_id"),
        F.when(u % 4 != 0, text("m", F.floor(u / 2).cast("string"))).alias("user_id"),
        text("app", (u % 2).cast("string")).alias("app_id"),
        _pick(u % 3, ["Web", "Android", "iOS"]).alias("platform"),
        text(u.cast("string"), "-", F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.when(kind.isin("view", "click"), F.round(F.col("value") * 100).cast("long"))
        .alias("user_engagement_time_msec"),
        F.when(kind == "purchase", F.col("value")).alias("event_value"),
        F.when(page, text("title ", (k % 20).cast("string"))).alias("page_view_page_title"),
        F.when(page, text("/p/", (k % 10).cast("string"))).alias("page_view_page_url_path"),
        F.when(screen, text("screen ", (k % 20).cast("string"))).alias("screen_view_screen_name"),
        F.when(screen, text("sid", (k % 10).cast("string"))).alias("screen_view_screen_id"),
        text("NATION_", (u % 25).cast("string")).alias("geo_country"),
        text("city", (u % 7).cast("string")).alias("geo_city"),
        text("1.", (k % 4).cast("string")).alias("app_version"),
        F.when(~web, text("model", (u % 5).cast("string"))).alias("device_mobile_model_name"),
        _pick(u % 3, [None, "Android", "iOS"]).alias("device_operating_system"),
        F.when(~web, text("v", (u % 6).cast("string"))).alias("device_operating_system_version"),
        _pick(u % 4, ["Desktop", "Phone", "Pad", None]).alias("device_ua_device"),
        _pick(u % 3, ["Windows", "Android", "iOS"]).alias("device_ua_os"),
        _pick(u % 3, ["10", "14", "17"]).alias("device_ua_os_version"),
        _pick(u % 2, ["Chrome", "Safari"]).alias("device_ua_browser"),
        _pick(u % 3, ["PC", "Mobile", "Tablet"]).alias("device_ua_device_category"),
        F.when(u % 10 != 0, (F.lit(1080) + u % 3).cast("long")).alias("device_screen_width"),
        F.when(u % 10 != 0, (F.lit(1920) + u % 3).cast("long")).alias("device_screen_height"),
        _pick(k % 5, [None, "Direct", "google", "facebook", "example.org"]).alias("traffic_source_source"),
        _pick(k % 3, [None, "cpc", "organic"]).alias("traffic_source_medium"),
        _pick(k % 4, [None, "spring", "summer", "autumn"]).alias("traffic_source_campaign"),
        F.lit(None).cast("string").alias("traffic_source_content"),
        F.lit(None).cast("string").alias("traffic_source_term"),
        F.lit(None).cast("string").alias("traffic_source_campaign_id"),
        _pick(k % 2, [None, "gclid"]).alias("traffic_source_clid_platform"),
        F.lit(None).cast("string").alias("traffic_source_clid"),
        _pick(k % 5, [None, "Direct", "Paid Search", "Organic Social", "Referral"])
        .alias("traffic_source_channel_group"),
        _pick(k % 5, [None, "Direct", "Search", "Social", "Referral"]).alias("traffic_source_category"),
        _pick(u % 3, [None, "play", "appstore"]).alias("app_install_source"),
        F.create_map(
            F.lit("k"), F.struct(k.cast("string").alias("value"), F.lit("number").alias("type")),
            F.lit("kind"), F.struct(kind.alias("value"), F.lit("string").alias("type")),
        ).alias("custom_parameters"),
        F.lit(1).cast("long").alias("session_number"),
        F.lit("2.0").alias("sdk_version"),
        _pick(u % 3, ["web", "android", "ios"]).alias("sdk_name"),
        F.unix_millis("ts").alias("ingest_time_msec"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("created_time"),
    )


def with_session_facts(events: DataFrame) -> DataFrame:
    """Adds session start, duration so far and the entrance flag.

    The per-session facts come from one map-side-combined aggregate joined back,
    not from a window, so a session with very many events is never one task.
    """
    is_view = F.col("event_name").isin(VIEW_EVENTS)
    order = F.struct("event_timestamp", "event_id")
    facts = events.groupBy("session_id").agg(
        F.min("event_time_msec").alias("session_start_time_msec"),
        F.min(F.when(is_view, order)).alias("_first_view"),
    )
    return (
        events.join(facts, "session_id", "left")
        .withColumn("session_duration", F.col("event_time_msec") - F.col("session_start_time_msec"))
        .withColumn(
            "page_view_entrances",
            F.when(is_view & (order == F.col("_first_view")), F.lit("true")).otherwise(F.lit("false")),
        )
        .drop("_first_view")
    )


def with_duplicates(events: DataFrame) -> DataFrame:
    """A feed in which every tenth event arrives again an hour later, corrected."""
    again = (
        events.where(F.substring("event_id", 2, 20).cast("long") % 10 == 0)
        .withColumn("created_time", F.col("created_time") + F.expr("INTERVAL 1 HOUR"))
        .withColumn("event_value", F.col("event_value") + 1)
    )
    return events.unionByName(again)


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: id, first touch and first traffic source."""
    events = events_view(spark, sf_dir)
    first = F.min_by(
        F.struct(
            *[F.col(f"traffic_source_{f}").alias(f"first_traffic_{f}")
              for f in ["source", "medium", "campaign", "clid_platform", "channel_group", "category"]],
            F.col("app_install_source").alias("first_app_install_source"),
        ),
        F.struct("event_timestamp", "event_id"),
    ).alias("first")
    n = F.substring("user_pseudo_id", 2, 20).cast("long")
    shift = F.when(n % 7 == 0, F.lit(86_400_000)).otherwise(F.lit(0))
    return (
        events.groupBy("user_pseudo_id")
        .agg(
            F.max("user_id").alias("user_id"), F.max("app_id").alias("app_id"),
            F.min("event_time_msec").alias("_first_msec"),
            F.max("event_timestamp").alias("event_timestamp"), first,
        )
        .withColumn("first_touch_time_msec", (F.col("_first_msec") - shift).cast("long"))
        .withColumn("first_visit_date", F.timestamp_millis("first_touch_time_msec").cast("date"))
        .select("user_pseudo_id", "user_id", "app_id", "event_timestamp",
                "first_touch_time_msec", "first_visit_date", "first.*")
    )


def sessions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_sessions(with_session_facts(events_view(spark, sf_dir)))
