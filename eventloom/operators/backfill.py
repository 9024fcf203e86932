"""Moving the first table layout into the current one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.props import EVENT_MAP
from eventloom.names import FIRST_OPEN, SESSION_START, TRAFFIC_FIELDS
from eventloom.operators.dedupe import keep_one
from eventloom.operators.sessions import SOURCE_FIELDS
from eventloom.session import finished

# Parameter -> (column, type). Fixed values.
PARAMETERS = {
    "_screen_name": ("screen_view_screen_name", "string"), "_screen_id": ("screen_view_screen_id", "string"),
    "_screen_unique_id": ("screen_view_screen_unique_id", "string"),
    "_previous_screen_name": ("screen_view_previous_screen_name", "string"),
    "_previous_screen_id": ("screen_view_previous_screen_id", "string"),
    "_previous_screen_unique_id": ("screen_view_previous_screen_unique_id", "string"),
    "_page_referrer": ("page_view_page_referrer", "string"),
    "_page_referrer_title": ("page_view_page_referrer_title", "string"),
    "_page_title": ("page_view_page_title", "string"), "_page_url": ("page_view_page_url", "string"),
    "_page_url_path": ("page_view_page_url_path", "string"),
    "_latest_referrer": ("page_view_latest_referrer", "string"),
    "_latest_referrer_host": ("page_view_latest_referrer_host", "string"),
    "_entrances": ("page_view_entrances", "boolean"), "_session_id": ("session_id", "string"),
    "_session_start_timestamp": ("session_start_time_msec", "bigint"), "_session_duration": ("session_duration", "bigint"),
    "_session_number": ("session_number", "bigint"), "_search_key": ("search_key", "string"),
    "_search_term": ("search_term", "string"), "_link_classes": ("outbound_link_classes", "string"),
    "_link_domain": ("outbound_link_domain", "string"), "_link_id": ("outbound_link_id", "string"),
    "_link_url": ("outbound_link_url", "string"), "_outbound": ("outbound_link", "boolean"),
    "_engagement_time_msec": ("user_engagement_time_msec", "bigint"), "_error_code": ("sdk_error_code", "string"),
    "_error_message": ("sdk_error_message", "string"), "_exception_message": ("app_exception_message", "string"),
    "_exception_stack": ("app_exception_stack", "string"), "_is_first_time": ("app_start_is_first_time", "boolean"),
    "_previous_app_version": ("upgrade_previous_app_version", "string"),
    "_previous_os_version": ("upgrade_previous_os_version", "string"),
}
# The mobile first session is found by these events. Fixed values.
MOBILE_SESSION_EVENTS = ["_screen_view", "_app_end"]


def _entry(key: Column, v: Column) -> Column:
    text = F.coalesce(v["string_value"], v["double_value"].cast("string"), v["int_value"].cast("string"))
    kind = F.when(v["string_value"].isNotNull(), "string").otherwise("number")
    return F.struct(key.alias("key"), F.struct(text.alias("value"), kind.alias("type")).alias("value"))


def backfill_events(old: DataFrame, params: DataFrame | None = None, done: DataFrame | None = None,
                    since_msec: int | None = None) -> DataFrame:
    """Wide events from nested events.

    Known parameters become columns, the others a typed map. An event holds its
    parameters, so they are read where they are and nothing is shuffled; only where
    they are stored apart (`params`, one row per event and parameter) do they meet
    in an aggregation by event id. Events already in `done` are left out, with their
    parameters, so the job can stop and be run again, and `since_msec` cuts the work
    into time windows.
    """
    def left(rows: DataFrame) -> DataFrame:
        rows = rows if since_msec is None else rows.where(F.col("event_timestamp") >= since_msec)
        return rows if done is None else rows.join(done.select("event_id"), "event_id", "left_anti")

    rows = left(old)
    if params is None:
        rows = rows.withColumn("_params", F.map_from_entries(F.array_sort(F.array_distinct(
            F.transform("event_params", lambda p: _entry(p["key"], p["value"]))))))
    else:
        value = F.struct(*[F.col(f"event_param_{t}_value").alias(f"{t}_value") for t in ("string", "double", "int")])
        pairs = left(params).select("event_id", _entry(F.col("event_param_key"), value).alias("p")).groupBy("event_id").agg(
            F.map_from_entries(F.array_sort(F.collect_set("p"))).alias("_params"))
        rows = rows.join(pairs, "event_id", "left")
    known = list(PARAMETERS)
    col = lambda c: F.col("_params")[c]["value"]
    empty_null = lambda c: F.nullif(c, F.lit(""))
    device = ["mobile_brand_name", "mobile_model_name", "manufacturer", "carrier", "network_type", "operating_system",
              "operating_system_version", "system_language", "screen_width", "screen_height"]
    return rows.select(
        F.timestamp_millis("event_timestamp").alias("event_timestamp"), "event_id",
        F.col("event_timestamp").alias("event_time_msec"), "event_name", F.lit("USD").alias("event_value_currency"),
        "event_bundle_sequence_id", F.col("ingest_timestamp").alias("ingest_time_msec"),
        *[F.col(f"device.{f}").alias(f"device_{f}") for f in device],
        F.col("geo.country").alias("geo_country"), F.col("geo.city").alias("geo_city"), F.col("geo.locale").alias("geo_locale"),
        empty_null(F.col("traffic_source.source")).alias("traffic_source_source"),
        empty_null(F.col("traffic_source.medium")).alias("traffic_source_medium"),
        *[F.lit(None).cast("string").alias(f"traffic_source_{f}") for f in TRAFFIC_FIELDS if f not in ("source", "medium")],
        F.col("app_info.id").alias("app_package_id"), F.col("app_info.app_id").alias("app_id"),
        F.col("app_info.version").alias("app_version"), F.col("app_info.install_source").alias("app_install_source"),
        F.coalesce("platform", F.lit("Web")).alias("platform"), "project_id", "user_id", "user_pseudo_id",
        *[col(k).try_cast(t).alias(c) for k, (c, t) in PARAMETERS.items()],
        F.map_filter("_params", lambda k, v: ~k.isin(known)).cast(EVENT_MAP).alias("custom_parameters"),
        F.create_map(F.lit("backfill_event"), F.lit("true")).alias("process_info"),
    )


def windows(first: dt.date, last: dt.date, days: int) -> list[tuple[dt.date, dt.date]]:
    """Periods of so many days from the newest to the oldest, the end exclusive; the oldest may be shorter."""
    out, end = [], last + dt.timedelta(days=1)
    while end > first:
        out.append((max(first, end - dt.timedelta(days=days)), end))
        end = out[-1][0]
    return out


def backfill_windows(old: DataFrame, path: str, first: dt.date, last: dt.date, days: int, params: DataFrame | None = None,
                     stop_after: int | None = None) -> list[str]:
    """Moves the events of the days `first` to `last` window by window into folders under `path`; returns the windows moved.

    A window is a folder, and complete when its write is: run again, the job goes on with the first window that is not
    complete, without reading what has been moved or the ids of it. A window that was cut short is written anew.
    The bounds are on the stored clock, so a window scans its own days only; events of wrong clocks, before the first or after
    the last day, go with the oldest and the newest window. `stop_after` ends a run after so many windows.
    """
    spark, moved = old.sparkSession, []
    done, all_ = set(finished(spark, path)), windows(first, last, days)
    at = F.col("event_timestamp")
    for low, high in all_:
        name = f"window={low:%Y%m%d}-{high:%Y%m%d}"
        if name in done:
            continue
        if stop_after is not None and len(moved) >= stop_after:
            break
        since, until = (int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp() * 1000) for d in (low, high))
        held = (F.lit(low == all_[-1][0]) | (at >= since)) & (F.lit(high == all_[0][1]) | (at < until))
        inside, own = old.where(held), params if params is None else params.where(held)
        backfill_events(inside, own).write.mode("overwrite").parquet(f"{path}/{name}")
        moved.append(name)
    return moved


def backfilled(spark: SparkSession, path: str) -> DataFrame:
    """The events of all complete windows. Raises if there are none yet."""
    return spark.read.parquet(*[f"{path}/{name}" for name in finished(spark, path)])


def _property_map(entries: str, with_time: bool):
    def value(e):
        v = e["value"]
        text = F.coalesce(v["string_value"], v["int_value"].cast("string"), v["double_value"].cast("string"))
        kind = F.when(v["string_value"].isNotNull(), "string").when(text.isNotNull(), "number")
        fields = [text.alias("value"), kind.alias("type")]
        if with_time:
            fields.append(F.floor(v["set_timestamp_micros"] / 1000).alias("set_time_msec"))
        return F.struct(e["key"].alias("key"), F.struct(*fields).alias("value"))
    return F.map_from_entries(F.transform(entries, value))


def backfill_users(old: DataFrame, events: DataFrame) -> DataFrame:
    """Property map and first traffic source of the old users.

    Web users take the greatest values of their first-open events. Others take
    those of their first session, found by the earliest screen or app-end event.
    """
    traffic = [f"traffic_source_{f}" for f in TRAFFIC_FIELDS]
    web_rows = events.where((F.col("event_name") == FIRST_OPEN) & (F.col("platform") == "Web"))
    first = lambda referrer: [F.max(referrer).alias("first_referrer"),
                              *[F.max(c).alias(f"first_{c.replace('_source_', '_', 1)}") for c in traffic],
                              F.max("app_install_source").alias("first_app_install_source")]
    web = web_rows.groupBy("user_pseudo_id").agg(*first("page_view_page_referrer"))
    mobile_rows = events.where(F.col("platform") != "Web")
    opening = keep_one(
        mobile_rows.where(F.col("event_name").isin(MOBILE_SESSION_EVENTS) & F.col("session_id").isNotNull()).select(
            "user_pseudo_id", "session_id", "event_timestamp", "event_id"),
        ["user_pseudo_id"], ["event_timestamp", "event_id"], latest=False).select("user_pseudo_id", "session_id")
    mobile = (
        mobile_rows.where(F.col("traffic_source_source").isNotNull()).join(opening, ["user_pseudo_id", "session_id"], "left_semi")
        .groupBy("user_pseudo_id").agg(*first("page_view_latest_referrer")))
    names = [c for c in web.columns if c != "user_pseudo_id"]
    both = web.select("user_pseudo_id", F.struct(*names).alias("w")).join(
        mobile.select("user_pseudo_id", F.struct(*names).alias("m")), "user_pseudo_id", "full_outer")
    return old.select(
        "app_id", "user_pseudo_id", F.timestamp_millis("event_timestamp").alias("event_timestamp"), "user_id",
        F.col("user_first_touch_timestamp").alias("first_touch_time_msec"), "first_visit_date",
        _property_map("user_properties", True).alias("user_properties"),
    ).join(both, "user_pseudo_id", "left").select(
        "app_id", "user_pseudo_id", "event_timestamp", "user_id", "first_touch_time_msec", "first_visit_date", "user_properties",
        # The mobile step runs after the web step and overrides it.
        *[F.when(F.col("m").isNotNull(), F.col(f"m.{c}")).otherwise(F.col(f"w.{c}")).alias(c) for c in names])


def backfill_sessions(events: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Sessions rebuilt from events; web sessions take their source from session starts."""
    rows = events.where(F.col("session_id").isNotNull())
    keys = ["app_id", "user_pseudo_id", "session_id"]
    if done is not None:
        rows = rows.join(done.select(*keys), keys, "left_anti")
    web = (F.col("event_name") == SESSION_START) & (
        (F.col("platform") == "Web") | F.col("platform").isNull() | F.col("page_view_page_url").isNotNull())
    return rows.groupBy(*keys).agg(
        F.max("user_id").alias("user_id"), F.max("session_number").alias("session_number"),
        F.min("session_start_time_msec").alias("session_start_time_msec"),
        F.max("event_timestamp").alias("event_timestamp"),
        *[F.max(F.when(web, F.col(f"traffic_source_{f}"))).alias(s) for f, s in zip(TRAFFIC_FIELDS, SOURCE_FIELDS)])


def backfill_items(old: DataFrame, items: DataFrame) -> DataFrame:
    """Item rows from nested items, with the properties stored per item and time."""
    i = lambda n: F.col(f"i.{n}")
    props = items.select(F.col("event_timestamp").alias("event_time_msec"), F.col("id").alias("item_id"),
                         _property_map("properties", False).alias("custom_parameters"))
    rows = old.select(
        F.col("event_timestamp").alias("event_time_msec"), F.timestamp_millis("event_timestamp").alias("event_timestamp"),
        "event_id", "event_name", "platform", "user_pseudo_id", "user_id", F.explode("items").alias("i")).select(
        "event_time_msec", "event_timestamp", "event_id", "event_name", "platform", "user_pseudo_id", "user_id",
        i("id").alias("item_id"), i("name").alias("name"), i("brand").alias("brand"), i("currency").alias("currency"),
        i("price").alias("price"), i("quantity").cast("double").alias("quantity"), i("category").alias("category"),
        i("creative_name").alias("creative_name"), i("creative_slot").alias("creative_slot"),
    ).where(F.col("item_id").isNotNull()).distinct()
    # Only items known to the item table at that time are moved.
    return rows.join(keep_one(props, ["event_time_msec", "item_id"], [F.map_keys("custom_parameters")]),
                     ["event_time_msec", "item_id"])
