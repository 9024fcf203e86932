"""The event, item and user tables cut from parsed events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.props import USER_MAP, merge, tagged, typed, variant_map, without
from eventloom.functions.text import max_bytes, too_long
from eventloom.names import FIRST_TOUCH_EVENTS, PROFILE_SET, TRAFFIC_FIELDS
from eventloom.operators.dedupe import keep_one

PARSE_ONLY = ["user_json", "items_json", "raw_page_url", "raw_page_referrer", "raw_latest_referrer"]
USER_KEYS = ["app_id", "user_pseudo_id"]

# Byte limits for stores that cannot hold more, for `limits`; nothing is cut by default. Fixed values.
EVENT_LIMITS = {
    "event_value_currency": 32, "event_id": 255, "event_name": 255, "device_mobile_brand_name": 255,
    "device_mobile_model_name": 255, "device_manufacturer": 255, "device_carrier": 255, "device_network_type": 255,
    "device_operating_system": 255, "device_operating_system_version": 255, "app_package_id": 255,
    "app_version": 255, "app_title": 255, "platform": 255, "project_id": 255, "app_id": 255, "user_pseudo_id": 255,
    "user_id": 255, "session_id": 255, "traffic_source_source": 255, "traffic_source_medium": 255,
    "traffic_source_campaign": 255, "traffic_source_content": 2048, "traffic_source_term": 2048,
    "traffic_source_clid": 2048, "page_view_page_title": 2048, "page_view_page_url": 2048,
    "page_view_page_referrer": 2048, "search_term": 2048,
}


def add_process_info(df: DataFrame, job: str, at: dt.datetime) -> DataFrame:
    stamp = F.create_map(F.lit("process_job_id"), F.lit(job), F.lit("process_time"), F.lit(at.isoformat()))
    return df.withColumn("process_info", merge(F.col("process_info"), stamp)).withColumn(
        "created_time", F.lit(at).cast("timestamp"))


def limited(rows: DataFrame, limits: dict[str, int] | None) -> tuple[DataFrame, DataFrame | None]:
    """A table for a store with limits, and the rows that do not fit, whole, for the side output.

    Every limited column gets `<column>_truncated`. Without limits the table is as it is and nothing is left out.
    """
    limits = {c: n for c, n in (limits or {}).items() if c in rows.columns}
    if not limits:
        return rows, None
    return max_bytes(rows, limits), rows.where(too_long(limits))


def extract_events(parsed: DataFrame, job: str, at: dt.datetime) -> DataFrame:
    """The event table: parse helpers dropped, process info added, text whole."""
    return add_process_info(parsed.drop(*PARSE_ONLY), job, at)


ITEM_SCHEMA = (
    "array<struct<id:string,item_id:string,name:string,item_name:string,category:string,category2:string,"
    "category3:string,category4:string,category5:string,price:string,quantity:string,brand:string,currency:string,"
    "creative_name:string,creative_slot:string,location_id:string>>"
)
ITEM_FIELDS = ["category", "category2", "category3", "category4", "category5", "brand", "currency",
               "creative_name", "creative_slot", "location_id"]
ITEM_KNOWN = ["id", "item_id", "name", "item_name", "price", "quantity", *ITEM_FIELDS]


def extract_items(parsed: DataFrame) -> DataFrame:
    """One row per item with an id; repeats of (event, user, item) are dropped."""
    pair = F.arrays_zip(F.from_json("items_json", ITEM_SCHEMA).alias("i"),
                        F.from_json("items_json", "array<string>").alias("j"))
    keys = ["event_id", "user_pseudo_id", "item_id"]
    head = ["event_timestamp", "event_id", "event_name", "platform", "user_pseudo_id", "user_id", "app_id"]
    i = lambda n: F.col(f"x.i.{n}")
    rows = parsed.select(*head, F.posexplode(pair).alias("_position", "x")).select(
        *head, "_position", F.coalesce(i("item_id"), i("id")).alias("item_id"),
        F.coalesce(i("item_name"), i("name")).alias("name"), *[i(f).alias(f) for f in ITEM_FIELDS],
        i("price").try_cast("double").alias("price"), i("quantity").try_cast("double").alias("quantity"),
        typed(without(variant_map(F.col("x.j")), ITEM_KNOWN)).alias("custom_parameters"),
    ).where(F.coalesce(F.col("item_id"), F.lit("")) != "")
    return keep_one(rows, keys, ["event_timestamp", "_position"], latest=False).drop("_position")


def user_properties(user_json: Column) -> Column:
    """Typed map of the user's members: {"name": {"value": ..., "set_timestamp": ...}}."""
    members = F.from_json(user_json, "map<string,struct<value:variant,set_timestamp:bigint>>")
    return F.transform_values(members, lambda k, v: tagged(v["value"], v["set_timestamp"].alias("set_time_msec")))


def user_rows(parsed: DataFrame) -> DataFrame:
    """What each event says about its user."""
    touch = F.col("user_first_touch_time_msec")
    props = (F.col("user_properties") if "user_properties" in parsed.columns
             else user_properties(F.col("user_json"))).cast(USER_MAP)
    install = F.col("app_install_source") if "app_install_source" in parsed.columns else F.lit(None).cast("string")
    return parsed.select(
        *USER_KEYS, "event_timestamp", "event_id", "event_name", "user_id", props.alias("user_properties"),
        touch.alias("first_touch_time_msec"), F.timestamp_millis(touch).cast("date").alias("first_visit_date"),
        F.coalesce(F.col("page_view_page_referrer"), F.col("page_view_latest_referrer")
                   if "page_view_latest_referrer" in parsed.columns else F.lit(None)).alias("first_referrer")
        if "first_referrer" not in parsed.columns else F.col("first_referrer"),
        *[F.col(f"traffic_source_{f}").alias(f"first_traffic_{f}") for f in TRAFFIC_FIELDS],
        install.alias("first_app_install_source"), "process_info",
    )


FIRST_COLUMNS = ["first_touch_time_msec", "first_visit_date", "first_referrer",
                 *[f"first_traffic_{f}" for f in TRAFFIC_FIELDS], "first_app_install_source"]


def _at() -> Column:
    return F.struct("event_timestamp", "event_id")


def partial_users(rows: DataFrame, third_party: bool = False) -> DataFrame:
    """One mergeable row per user: each choice keeps the position it was made at.

    First-touch fields come from the earliest of the first-touch events (third
    party: of any event), properties from the latest profile event (third party:
    from the latest row that has any). `merge_users` combines such rows in any
    order and grouping, so batches, history and streams give the same users.
    """
    return partial_rows(rows, third_party).transform(merge_users)


def partial_rows(rows: DataFrame, third_party: bool = False) -> DataFrame:
    """What `merge_users` takes, one row per event."""
    is_first = F.lit(True) if third_party else F.col("event_name").isin(FIRST_TOUCH_EVENTS)
    has_props = F.col("user_properties").isNotNull()
    is_latest = has_props if third_party else has_props & (F.col("event_name") == PROFILE_SET)
    return rows.select(
        *USER_KEYS, "event_timestamp", "user_id", "process_info",
        F.when(is_first, F.struct(_at().alias("at"), F.col("event_name").alias("name"),
                                  F.struct(*FIRST_COLUMNS).alias("row"))).alias("first"),
        F.when(is_latest, F.struct(_at().alias("at"), F.col("event_name").alias("name"),
                                   F.col("user_properties").alias("props"))).alias("latest"),
        _at().alias("info_at"),
    )


def merge_users(partials: DataFrame) -> DataFrame:
    """One aggregation with a partial step replaces three aggregates and two joins."""
    return partials.where(F.col("user_pseudo_id").isNotNull()).groupBy(*USER_KEYS).agg(
        F.max("event_timestamp").alias("event_timestamp"),
        F.max("user_id").alias("user_id"),
        F.min_by("process_info", "info_at").alias("process_info"),
        F.min_by("first", "first.at").alias("first"),
        F.max_by("latest", "latest.at").alias("latest"),
        F.min("info_at").alias("info_at"),
    )


def finish_users(partials: DataFrame, *more: str) -> DataFrame:
    """The stored user columns, and others to keep."""
    names = F.create_map(F.lit("latest_event_name"), F.col("latest.name"),
                         F.lit("first_event_name"), F.col("first.name"))
    return partials.select(
        *USER_KEYS, "event_timestamp", "user_id", F.col("latest.props").alias("user_properties"),
        F.to_json("latest.props").alias("user_properties_json_str"), "first.row.*",
        merge(F.col("process_info"), names).alias("process_info"), *more)


def extract_users(parsed: DataFrame, third_party: bool = False) -> DataFrame:
    return finish_users(partial_users(user_rows(parsed), third_party))


def merge_user_state(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Full picture of the users seen in this batch; both sides are partial users."""
    seen = batch.select(*USER_KEYS)
    return finish_users(merge_users(history.unionByName(batch).join(seen, USER_KEYS, "left_semi")))
