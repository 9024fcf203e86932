"""The first table layout: nested events, long parameters, items and users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import url
from eventloom.functions.let import let
from eventloom.functions.props import value_text, variant_map, without
from eventloom.operators.dedupe import keep_one
from eventloom.operators.parse import uri_pairs
from eventloom.operators.webtag import mapped_name

VALUE = "struct<double_value:double,float_value:float,int_value:bigint,string_value:string>"
KEY_VALUES = f"array<struct<key:string,value:{VALUE}>>"

# Attributes that have columns of their own and stay out of the parameters. Fixed values.
OWN_COLUMNS = [
    "_privacy_info_ads_storage", "_privacy_info_analytics_storage", "_privacy_info_uses_transient_token",
    "_traffic_source_medium", "_traffic_source_name", "_traffic_source_source", "_channel",
]
# The columns of the nested event. Fixed values.
EVENT_COLUMNS = [
    "app_info", "device", "ecommerce", "event_bundle_sequence_id", "event_date", "event_dimensions", "event_id",
    "event_name", "event_params", "event_previous_timestamp", "event_server_timestamp_offset", "event_timestamp",
    "event_value_in_usd", "geo", "ingest_timestamp", "items", "platform", "privacy_info", "project_id",
    "traffic_source", "user_first_touch_timestamp", "user_id", "user_ltv", "user_properties", "user_pseudo_id",
]
MARKERS = ["event_params", "event_bundle_sequence_id", "items", "user_properties"]
PROFILE_EVENTS = ["user_profile_set", "_user_profile_set", "_profile_set"]
FIRST_EVENTS = ["_first_open", "_first_visit"]
USER_EVENTS = [*PROFILE_EVENTS, *FIRST_EVENTS, "_app_end", "_app_start"]
KEYS = ["app_id", "user_pseudo_id"]


def typed_value(v: Column, *more: Column) -> Column:
    """One of double, whole number or text, whole; objects and booleans are text."""
    def build(kind: Column) -> Column:
        whole, real = kind == "BIGINT", kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "FLOAT")
        return F.struct(
            F.when(real, v.try_cast("double")).alias("double_value"), F.lit(None).cast("float").alias("float_value"),
            F.when(whole, v.try_cast("bigint")).alias("int_value"),
            F.when(~whole & ~real, value_text(v)).alias("string_value"), *more)
    return let(F.schema_of_variant(v), build)


def kv_array(members: Column) -> Column:
    """map<string,variant> as an array of key and typed value."""
    return F.transform(F.map_entries(members), lambda m: F.struct(
        m["key"].alias("key"), typed_value(m["value"]).alias("value")))


def user_props(user_json: Column) -> Column:
    """User members but lifetime value, each with the time it was set."""
    members = F.from_json(user_json, "map<string,struct<value:variant,set_timestamp:bigint>>")
    kept = F.map_filter(members, lambda k, v: ~k.startswith("_user_ltv_"))
    return F.transform(F.map_entries(kept), lambda m: F.struct(m["key"].alias("key"), typed_value(
        m["value"]["value"], (m["value"]["set_timestamp"] * 1000).alias("set_timestamp_micros")).alias("value")))


def user_ltv(user_json: Column) -> Column:
    revenue = F.get_json_object(user_json, "$._user_ltv_revenue.value").try_cast("double")
    return F.when(revenue.isNotNull(), F.struct(
        revenue.alias("revenue"), F.get_json_object(user_json, "$._user_ltv_currency.value").alias("currency")))


def ods_events(entries: DataFrame, project_id: str = "project") -> DataFrame:
    """Nested events from clean entries."""
    e = lambda n: F.col(f"e.{n}")
    attr = lambda n: F.get_json_object("e.attributes", f"$.{n}")
    text = lambda n: F.lit(None).cast("string").alias(n)
    bundle = url.first_param(uri_pairs(), "event_bundle_sequence_id")
    privacy = F.array(*[F.struct(F.lit(n).alias("key"), F.struct(
        F.lit(None).cast("double").alias("double_value"), F.lit(None).cast("float").alias("float_value"),
        F.lit(None).cast("bigint").alias("int_value"), attr(f"_privacy_info_{n}").alias("string_value")).alias("value"))
        for n in ("ads_storage", "analytics_storage", "uses_transient_token")])
    return entries.select(
        F.struct(e("app_id").alias("app_id"), e("app_package_name").alias("id"), attr("_channel").alias("install_source"),
                 e("app_version").alias("version"), e("sdk_version").alias("sdk_version"), e("sdk_name").alias("sdk_name"))
        .alias("app_info"),
        F.struct(
            e("brand").alias("mobile_brand_name"), e("model").alias("mobile_model_name"), e("make").alias("manufacturer"),
            e("screen_width").alias("screen_width"), e("screen_height").alias("screen_height"), e("carrier").alias("carrier"),
            e("network_type").alias("network_type"), e("os_version").alias("operating_system_version"),
            e("platform").alias("operating_system"), *[text(f"ua_{n}") for n in
                                                       ("browser", "browser_version", "os", "os_version", "device", "device_category")],
            e("system_language").alias("system_language"), (e("zone_offset") / 1000).cast("bigint").alias("time_zone_offset_seconds"),
            e("device_id").alias("vendor_id"), e("device_unique_id").alias("advertising_id"), e("host_name").alias("host_name"),
            e("viewport_width").alias("viewport_width"), e("viewport_height").alias("viewport_height")).alias("device"),
        text("ecommerce"), F.coalesce(bundle.try_cast("bigint"), F.lit(0)).alias("event_bundle_sequence_id"),
        F.to_date(F.timestamp_millis(e("timestamp"))).alias("event_date"), text("event_dimensions"), e("event_id").alias("event_id"),
        e("event_type").alias("event_name"),
        kv_array(without(variant_map(e("attributes")), OWN_COLUMNS)).alias("event_params"),
        e("event_previous_timestamp").alias("event_previous_timestamp"),
        (F.col("ingest_time") - e("timestamp")).alias("event_server_timestamp_offset"), e("timestamp").alias("event_timestamp"),
        F.lit(None).cast("float").alias("event_value_in_usd"),
        F.struct(text("country"), text("continent"), text("sub_continent"), e("locale").alias("locale"), text("region"),
                 text("metro"), text("city")).alias("geo"),
        F.col("ingest_time").alias("ingest_timestamp"),
        F.from_json(e("items"), "array<struct<id:string,quantity:bigint,price:double,currency:string,"
                                "creative_name:string,creative_slot:string,name:string,brand:string,category:string>>").alias("items"),
        e("platform").alias("platform"), privacy.alias("privacy_info"), F.lit(project_id).alias("project_id"),
        F.struct(attr("_traffic_source_medium").alias("medium"), attr("_traffic_source_name").alias("name"),
                 attr("_traffic_source_source").alias("source")).alias("traffic_source"),
        F.get_json_object(e("user"), "$._user_first_touch_timestamp.value").try_cast("bigint").alias("user_first_touch_timestamp"),
        F.get_json_object(e("user"), "$._user_id.value").alias("user_id"), user_ltv(e("user")).alias("user_ltv"),
        user_props(e("user")).alias("user_properties"), e("unique_id").alias("user_pseudo_id"),
        F.col("ua"), F.col("ip"), e("items").alias("items_json"), e("attributes").alias("attributes_json"),
        e("device_id").alias("device_id"),
    )


def project_v1(df: DataFrame) -> DataFrame:
    """The nested output columns, where the frame is a nested event table; else the frame as it is."""
    return df.select(*EVENT_COLUMNS) if set(MARKERS) <= set(df.columns) else df


def event_parameters(events: DataFrame) -> DataFrame:
    """One row per event and parameter."""
    v = lambda n: F.col(f"p.value.{n}")
    return events.select(
        F.col("app_info.app_id").alias("app_id"), "event_date", "event_timestamp", "event_id", "event_name",
        F.explode("event_params").alias("p"),
    ).select(
        "app_id", "event_date", "event_timestamp", "event_id", "event_name", F.col("p.key").alias("event_param_key"),
        v("double_value").alias("event_param_double_value"), v("float_value").alias("event_param_float_value"),
        v("int_value").alias("event_param_int_value"), v("string_value").alias("event_param_string_value"))


def item_rows(events: DataFrame) -> DataFrame:
    """(app, date, time, id, properties) per item with an id."""
    rows = events.select(F.col("app_info.app_id").alias("app_id"), "event_date", "event_timestamp", "event_id",
                         F.posexplode(F.from_json("items_json", "array<string>")).alias("position", "j"))
    return rows.select(
        "app_id", "event_date", "event_timestamp", "event_id", "position", F.get_json_object("j", "$.id").alias("id"),
        kv_array(without(variant_map(F.col("j")), ["id"])).alias("properties")).where(F.col("id").isNotNull())


def latest_items(events: DataFrame) -> DataFrame:
    """The latest row per item id; within one event the later entry wins."""
    return keep_one(item_rows(events), ["app_id", "id"], ["event_timestamp", "event_id", "position"])


def user_profile_v1(events: DataFrame) -> DataFrame:
    """Users from seven event types in one aggregation (each choice is a filtered min/max by time)."""
    name, at = F.col("event_name"), F.struct("event_timestamp", "event_id")
    attr = lambda n: F.get_json_object("attributes_json", f"$.{n}")
    first, profile = name.isin(FIRST_EVENTS), name.isin(PROFILE_EVENTS)
    referrer = F.coalesce(*[attr(n) for n in ("_page_referrer", "page_referrer", "referer", "referrer")])
    channel = attr("channel")
    source = F.col("traffic_source.source")
    earliest = lambda value, when: F.min_by(F.when(when, value), F.when(when, at))
    touch = F.coalesce(F.min("user_first_touch_timestamp"), F.max("event_timestamp"))
    grouped = events.where(F.col("user_pseudo_id").isNotNull() & name.isin(USER_EVENTS)).withColumn(
        "app_id", F.col("app_info.app_id")).groupBy(*KEYS).agg(
        F.max("event_date").alias("event_date"), F.max("event_timestamp").alias("event_timestamp"),
        touch.alias("user_first_touch_timestamp"),
        F.max_by(F.when(profile, F.struct("user_id", "user_properties", "user_ltv")), F.when(profile, at)).alias("p"),
        earliest(referrer, first & referrer.isNotNull()).alias("first_referer"),
        earliest(F.col("traffic_source"), (name == "_app_end") & source.isNotNull()).alias("t"),
        F.array_sort(F.collect_set(F.when(name == "_app_start", F.col("device_id")))).alias("device_id_list"),
        earliest(channel, first & channel.isNotNull()).alias("channel"),
    )
    return grouped.select(
        *KEYS, "event_date", "event_timestamp", "p.user_id", "user_first_touch_timestamp", "p.user_properties", "p.user_ltv",
        F.to_date(F.timestamp_millis("user_first_touch_timestamp")).alias("first_visit_date"), "first_referer",
        F.col("t.name").alias("first_traffic_source_type"), F.col("t.medium").alias("first_traffic_medium"),
        F.col("t.source").alias("first_traffic_source"),
        F.when(F.size("device_id_list") > 0, F.col("device_id_list")).alias("device_id_list"), "channel")


# ------------------------------------------------------------------ web tag v1


def _flat(json: Column) -> Column:
    """Scalars of a JSON object, and members of nested objects under dotted names."""
    members = variant_map(json)
    nested = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    scalars = F.map_filter(members, lambda k, v: ~nested(v))
    objects = F.map_entries(F.map_filter(members, lambda k, v: nested(v)))
    inner = F.flatten(F.transform(objects, lambda o: F.transform(
        F.map_entries(F.from_json(F.to_json(o["value"]), "map<string,variant>")),
        lambda m: F.struct(F.concat(o["key"], F.lit("."), m["key"]).alias("key"), m["value"].alias("value")))))
    return F.concat(F.map_entries(scalars), inner)


def web_tag_events_v1(uploads: DataFrame) -> DataFrame:
    """Events of the web tag in the first layout; any first-visit or session flag adds an event."""
    rest = [c for c in uploads.columns if c != "data"]
    rows = uploads.select(*rest, F.posexplode(F.from_json("data", "array<string>")).alias("position", "data"))
    g = lambda n: F.get_json_object("data", f"$['{n}']")
    session = F.coalesce(g("ga_session_id"), F.lit("0"))
    number = F.coalesce(g("ga_session_number"), F.lit("0"))
    start = F.get_json_object("data", "$['x-sst-system_properties'].request_start_time_ms").try_cast("bigint")
    first = F.get_json_object("data", "$['x-ga-system_properties'].fv").isNotNull()
    begun = F.get_json_object("data", "$['x-ga-system_properties'].ss").isNotNull()
    base = F.concat_ws("-", F.col("rid"), F.col("position").cast("string"), session, number)
    nth = lambda i: F.concat(base, F.lit("-"), i.cast("string"))
    copies = F.array_compact(F.array(
        F.struct(mapped_name(g("event_name")).alias("name"), base.alias("id")),
        F.when(first, F.struct(F.lit("_first_open").alias("name"), nth(F.lit(1)).alias("id"))),
        F.when(begun, F.struct(F.lit("_session_start").alias("name"),
                               nth(F.when(first, 2).otherwise(1)).alias("id")))))
    at = F.coalesce(start, F.col("ingest_time"))
    params = F.transform(_flat(F.col("data")), lambda m: F.struct(m["key"].alias("key"), typed_value(m["value"]).alias("value")))
    return rows.where(g("event_name").isNotNull() & g("client_id").isNotNull()).select(
        "*", F.explode(copies).alias("x")).select(
        F.struct(F.col("appId").alias("app_id")).alias("app_info"), F.to_date(F.timestamp_millis(at)).alias("event_date"),
        at.alias("event_timestamp"), F.col("x.id").alias("event_id"), F.col("x.name").alias("event_name"),
        g("client_id").alias("user_pseudo_id"), g("user_id").alias("user_id"), params.alias("event_params"),
        number.try_cast("bigint").alias("session_number"), g("page_referrer").alias("page_referrer"),
        F.regexp_replace(g("items"), '"item_id"', '"id"').alias("items_json"))


def web_tag_users_v1(events: DataFrame) -> DataFrame:
    """First visit and first referrer per user."""
    at = F.struct("event_timestamp", "event_id")
    has = F.col("page_referrer").isNotNull()
    return events.withColumn("app_id", F.col("app_info.app_id")).groupBy(*KEYS).agg(
        F.max("user_id").alias("user_id"), F.max("event_timestamp").alias("event_timestamp"),
        F.min("event_timestamp").alias("user_first_touch_timestamp"),
        F.min_by(F.when(has, F.col("page_referrer")), F.when(has, at)).alias("first_referer"),
    ).withColumn("first_visit_date", F.to_date(F.timestamp_millis("user_first_touch_timestamp")))


def previous_session_number(state: DataFrame, until_msec: Column | int, days: int = 2) -> DataFrame:
    """Greatest session number per user over the days before a point in time."""
    end = F.lit(until_msec) if isinstance(until_msec, int) else until_msec
    at = F.col("event_timestamp")
    return state.where((at < end) & (at >= end - days * 86_400_000)).groupBy(
        F.col("app_info.app_id").alias("app_id"), "user_pseudo_id").agg(F.max("session_number").alias("max_session_number"))
