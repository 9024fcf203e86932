"""Events of the third-party web tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import url
from eventloom.functions.props import merge, typed, variant_map, without
from eventloom.operators.clean import parse_elements, strip
from eventloom.operators.dedupe import keep_one

# Event names of other vendors -> our names. Fixed values.
EVENT_NAMES = {"page_view": "_page_view", "login": "_profile_set", "user_engagement": "_user_engagement", "click": "_click"}
# The payload's known members. Fixed values.
SCHEMA = (
    "event_name string, client_id string, user_id string, ga_session_id string, ga_session_number bigint, "
    "page_location string, page_referrer string, page_title string, language string, screen_resolution string, "
    "ip_override string, user_agent string, engagement_time_msec bigint, currency string, value double, "
    "client_hints struct<brands:array<struct<brand:string,version:string>>,"
    "full_version_list:array<struct<brand:string,version:string>>,mobile:boolean,model:string,platform:string,"
    "platform_version:string>, event_location struct<country:string,region:string>, "
    "`x-ga-system_properties` struct<fv:string,ss:string>, "
    "`x-sst-system_properties` struct<uc:string,request_start_time_ms:bigint>, "
    "`x-ga-mp2-user_properties` string, `x-ga-ur` string, items string"
)
KNOWN = ["event_name", "client_id", "user_id", "ga_session_id", "ga_session_number", "page_location", "page_referrer",
         "page_title", "language", "engagement_time_msec", "currency", "value", "items", "ip_override", "user_agent",
         "screen_resolution", "x-ga-mp2-user_properties"]
USER_FIELDS = ["user_id", "username", "email", "firstName", "lastName", "gender", "age", "persona"]


def mapped_name(c: Column, names: dict[str, str] = EVENT_NAMES) -> Column:
    out = c
    for theirs, ours in names.items():
        out = F.when(c == theirs, F.lit(ours)).otherwise(out)
    return out


def parse_web_tag(uploads: DataFrame, project_id: str = "project") -> DataFrame:
    """Flat rows; flags of the payload add a first-open and a session-start event."""
    data = F.col("data")
    elements = F.when(strip(data).startswith("["), F.from_json(data, "array<string>")).otherwise(F.array(data))
    filled = uploads.where(F.coalesce(strip(data), F.lit("")) != "")
    rows = parse_elements(filled, elements, SCHEMA, "g").where(F.coalesce(F.col("g.event_name"), F.lit("")) != "")
    g = lambda n: F.col(f"g.{n}")
    hints, sys, sst = g("client_hints"), F.col("g.`x-ga-system_properties`"), F.col("g.`x-sst-system_properties`")
    event_id = F.concat_ws("-", F.col("rid"), F.col("position").cast("string"), F.coalesce(g("ga_session_id"), F.lit("null")),
                           F.coalesce(g("ga_session_number").cast("string"), F.lit("x")))
    platform = F.coalesce(F.regexp_replace(hints["platform"], r"\W", ""),
                          F.when(hints["mobile"], F.lit("Mobile")), F.lit("Web"))
    size = F.split(g("screen_resolution"), "x")
    axis = lambda i: F.when(F.size(size) == 2, F.try_element_at(size, F.lit(i)).try_cast("bigint"))
    browser = F.try_element_at(hints["full_version_list"], F.lit(-1))
    first_visit = F.coalesce(~F.lower(sys["fv"]).isin("0", "false"), F.lit(False))
    session_start = F.coalesce(sys["ss"] == "1", F.lit(False))
    props = without(variant_map(F.col("data")), KNOWN)
    known_strings = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("client_id", "ip_override", "screen_resolution", "user_agent")]),
        F.array(*[F.struct(g(n).alias("value"), F.lit("string").alias("type"))
                  for n in ("client_id", "ip_override", "screen_resolution", "user_agent")]))
    user_members = variant_map(F.col("g.`x-ga-mp2-user_properties`"))
    at = F.timestamp_millis("ingest_time")
    extra = F.array_compact(F.array(
        F.struct(mapped_name(g("event_name")).alias("event_name"), event_id.alias("event_id")),
        F.when(first_visit, F.struct(F.lit("_first_open").alias("event_name"),
                                     F.concat(event_id, F.lit("-first-open")).alias("event_id"))),
        F.when(session_start, F.struct(F.lit("_session_start").alias("event_name"),
                                       F.concat(event_id, F.lit("-session-start")).alias("event_id")))))
    user_typed = F.transform_values(typed(user_members), lambda k, v: F.struct(
        v["value"].alias("value"), v["type"].alias("type"), F.lit(None).cast("bigint").alias("set_time_msec")))
    return rows.select("*", F.posexplode(extra).alias("copy", "x")).select(
        at.alias("event_timestamp"), F.col("x.event_id"), F.col("ingest_time").alias("event_time_msec"),
        F.col("x.event_name"), g("value").alias("event_value"), g("currency").alias("event_value_currency"),
        F.col("ingest_time").alias("ingest_time_msec"), F.col("appId").alias("app_id"), platform.alias("platform"),
        F.lit(project_id).alias("project_id"),
        F.try_element_at(hints["brands"], F.lit(1))["brand"].alias("device_mobile_brand_name"),
        hints["model"].alias("device_mobile_model_name"), hints["platform"].alias("device_operating_system"),
        hints["platform_version"].alias("device_operating_system_version"),
        g("language").alias("device_system_language"), browser["brand"].alias("device_ua_browser"),
        browser["version"].alias("device_ua_browser_version"), axis(1).alias("device_screen_width"),
        axis(2).alias("device_screen_height"),
        F.when(g("event_location").isNotNull(), g("event_location.country")).otherwise(sst["uc"]).alias("geo_country"),
        F.coalesce(g("event_location.region"), F.col("g.`x-ga-ur`")).alias("geo_region"),
        url.decode(g("page_referrer")).alias("page_view_page_referrer"),
        url.decode(g("page_title")).alias("page_view_page_title"),
        url.decode(g("page_location")).alias("page_view_page_url"),
        url.path(g("page_location")).alias("page_view_page_url_path"),
        url.host(g("page_location")).alias("page_view_hostname"),
        g("engagement_time_msec").alias("user_engagement_time_msec"), g("user_id").alias("user_id"),
        g("client_id").alias("user_pseudo_id"), g("ga_session_id").alias("session_id"),
        sst["request_start_time_ms"].alias("session_start_time_msec"), g("ga_session_number").alias("session_number"),
        g("ip_override").alias("ip"), g("user_agent").alias("ua"),
        merge(typed(props), known_strings).alias("custom_parameters"), user_typed.alias("user_properties"),
        F.coalesce(F.when(sst["request_start_time_ms"] > 0, sst["request_start_time_ms"]), F.col("ingest_time"))
        .alias("user_first_touch_time_msec"),
        g("items").alias("items_json"), (F.col("copy") == 0).alias("original"),
        g("page_location").alias("raw_page_url"), g("page_referrer").alias("raw_page_referrer"),
        F.lit(None).cast("string").alias("raw_latest_referrer"),
        F.lit(None).cast("string").alias("page_view_latest_referrer"),
        F.lit(None).cast("string").alias("page_view_latest_referrer_host"),
        *[F.lit(None).cast("string").alias(f"traffic_source_{f}") for f in
          ("source", "medium", "campaign", "content", "term", "campaign_id", "clid_platform", "clid",
           "channel_group", "category")],
        F.create_map(F.lit("rid"), F.col("rid")).alias("process_info"),
    )


def web_tag_items(parsed: DataFrame) -> DataFrame:
    """Items of the original events; the currency is the event's."""
    item = "array<struct<item_id:string,item_name:string,price:double>>"
    head = ["event_timestamp", "event_id", "event_name", "platform", "user_pseudo_id", "user_id", "app_id"]
    rows = parsed.where("original").select(
        *head, F.col("event_value_currency").alias("currency"),
        F.posexplode(F.from_json("items_json", item)).alias("_position", "i"))
    rows = rows.select(*head, "_position", "currency", F.col("i.item_id"), F.col("i.item_name").alias("name"),
                       F.col("i.price")).where(F.coalesce(F.col("item_id"), F.lit("")) != "")
    return keep_one(rows, ["event_id", "user_pseudo_id", "item_id"], ["event_timestamp", "_position"],
                    latest=False).drop("_position")
