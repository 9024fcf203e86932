"""Events of the second third-party SDK: form text with a packed list of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import url
from eventloom.functions.let import let
from eventloom.functions.props import merge, typed, variant_map, without
from eventloom.operators.clean import gunzip_base64, parse_elements, strip
from eventloom.operators.webtag import mapped_name

PROPERTIES = {
    "$city": "string", "$url": "string", "$title": "string", "$os": "string", "$os_version": "string",
    "$manufacturer": "string", "$model": "string", "$brand": "string", "$screen_width": "bigint",
    "$screen_height": "bigint", "$carrier": "string", "$timezone_offset": "int", "$app_name": "string",
    "$wifi": "boolean", "$network_type": "string", "$device_id": "string", "$event_duration": "bigint",
    "$referrer": "string", "$referrer_title": "string", "$is_first_time": "boolean", "$user_id": "string",
    "$browser_language": "string",
}
SCHEMA = (
    "time bigint, distinct_id string, anonymous_id string, event string, items string, "
    "identities struct<`$identity_android_id`:string,`$identity_login_id`:string>, "
    "lib struct<`$lib`:string,`$lib_version`:string,`$app_version`:string>, properties string"
)
KNOWN = ["time", "distinct_id", "anonymous_id", "event", "items", "identities", "lib", "properties"]


def payload(data):
    """JSON passes through; form text gives its data_list or data member, unpacked when it is packed."""
    plain = strip(data)
    is_json = plain.startswith("[") | plain.startswith("{")
    member = F.try_element_at(F.filter(
        F.split(plain, "&"), lambda p: p.startswith("data_list=") | p.startswith("data=")), F.lit(1))
    packed = url.decode(F.regexp_replace(member, "^(data_list|data)=", ""))
    text = F.try_to_binary(packed, F.lit("base64")).try_cast("string")
    readable = text.rlike(r"^(?s)[\[{].*[\]}]$")
    unpacked = gunzip_base64(F.when(~is_json, packed))
    return F.when(is_json, plain).when(F.coalesce(readable, F.lit(False)), text).otherwise(
        F.when(~unpacked.startswith("error: "), unpacked))


def parse_alt_sdk(uploads: DataFrame, project_id: str = "project") -> DataFrame:
    elements = let(payload(F.col("data")), lambda text: F.when(
        text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text)))
    property_schema = ", ".join(f"`{n}` {t}" for n, t in PROPERTIES.items())
    filled = uploads.where(F.coalesce(F.col("data"), F.lit("")) != "")
    rows = parse_elements(filled, elements, SCHEMA, "s").where(F.coalesce(F.col("s.event"), F.lit("")) != "")
    rows = rows.withColumn("p", F.from_json("s.properties", property_schema))
    s, p = (lambda n: F.col(f"s.{n}")), (lambda n: F.col(f"p.`{n}`"))
    event_id = F.concat_ws("-", F.col("rid"), F.col("position").cast("string"), F.coalesce(s("distinct_id"), F.lit("null")))
    extra = F.array_compact(F.array(
        F.struct(mapped_name(s("event")).alias("event_name"), event_id.alias("event_id")),
        F.when(p("$is_first_time"), F.struct(F.lit("_first_open").alias("event_name"),
                                             F.concat(event_id, F.lit("-first-open")).alias("event_id")))))
    login = F.col("s.identities.`$identity_login_id`")
    custom = merge(typed(without(variant_map(F.col("data")), KNOWN)),
                   typed(without(variant_map(s("properties")), list(PROPERTIES))))
    return rows.select("*", F.posexplode(extra).alias("copy", "x")).select(
        F.timestamp_millis("ingest_time").alias("event_timestamp"), F.col("x.event_id"),
        F.col("ingest_time").alias("event_time_msec"), F.col("x.event_name"),
        F.col("ingest_time").alias("ingest_time_msec"), F.col("appId").alias("app_id"),
        F.coalesce(p("$os"), F.lit("Web")).alias("platform"), F.lit(project_id).alias("project_id"),
        url.decode(p("$referrer")).alias("page_view_page_referrer"),
        url.decode(p("$title")).alias("page_view_page_title"), url.decode(p("$url")).alias("page_view_page_url"),
        url.decode(p("$referrer_title")).alias("page_view_page_referrer_title"),
        p("$timezone_offset").alias("device_time_zone_offset_seconds"), p("$carrier").alias("device_carrier"),
        F.coalesce(p("$network_type"), F.when(p("$wifi"), "WIFI").otherwise("CELLULAR")).alias("device_network_type"),
        p("$brand").alias("device_mobile_brand_name"), p("$model").alias("device_mobile_model_name"),
        p("$manufacturer").alias("device_manufacturer"), p("$os").alias("device_operating_system"),
        p("$os_version").alias("device_operating_system_version"), p("$screen_width").alias("device_screen_width"),
        p("$screen_height").alias("device_screen_height"), p("$browser_language").alias("device_system_language"),
        p("$city").alias("geo_city"), p("$event_duration").alias("user_engagement_time_msec"),
        F.coalesce(login, s("anonymous_id")).alias("user_id"), s("distinct_id").alias("user_pseudo_id"),
        s("time").alias("session_start_time_msec"), p("$device_id").alias("device_vendor_id"),
        p("$app_name").alias("app_title"), F.col("s.lib.`$lib_version`").alias("sdk_version"),
        F.col("s.lib.`$lib`").alias("sdk_name"), F.col("s.lib.`$app_version`").alias("app_version"),
        F.col("ip"), F.col("ua"), custom.alias("custom_parameters"), s("items").alias("items_json"),
        (F.col("copy") == 0).alias("original"), p("$url").alias("raw_page_url"),
        p("$referrer").alias("raw_page_referrer"), F.lit(None).cast("string").alias("raw_latest_referrer"),
        F.create_map(F.lit("rid"), F.col("rid")).alias("process_info"),
    )
