"""SDK events to flat event rows, as one projection of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import url
from eventloom.functions.props import merge, typed, variant_map, without
from eventloom.names import APP_START, PROFILE_SET, SCROLL, USER_ENGAGEMENT  # noqa: F401
from eventloom.operators.clean import EVENT_FIELDS

SHIFT_THRESHOLD_MSEC = 600_000

# Reserved attribute names and their types. Fixed values.
ATTRIBUTES = {
    "_screen_name": "string", "_screen_id": "string", "_screen_unique_id": "string",
    "_previous_screen_name": "string", "_previous_screen_id": "string", "_previous_screen_unique_id": "string",
    "_entrances": "boolean", "_previous_timestamp": "bigint", "_engagement_time_msec": "bigint",
    "_page_referrer": "string", "_page_referrer_title": "string", "_page_title": "string", "_page_url": "string",
    "_latest_referrer": "string", "_latest_referrer_host": "string", "_is_first_time": "boolean",
    "_exception_message": "string", "_exception_stack": "string", "_previous_app_version": "string",
    "_previous_os_version": "string", "_error_code": "string", "_error_message": "string", "_search_key": "string",
    "_search_term": "string", "_link_classes": "string", "_link_domain": "string", "_link_id": "string",
    "_link_url": "string", "_outbound": "boolean", "_session_id": "string", "_session_start_time_msec": "bigint",
    "_session_duration": "bigint", "_session_number": "bigint", "_app_install_channel": "string",
    "_traffic_source_source": "string", "_traffic_source_medium": "string", "_traffic_source_campaign": "string",
    "_traffic_source_content": "string", "_traffic_source_term": "string", "_traffic_source_campaign_id": "string",
    "_traffic_source_clid_platform": "string", "_traffic_source_clid": "string",
    "_traffic_source_channel_group": "string", "_traffic_source_category": "string", "_utm_id": "string",
    "_utm_source": "string", "_utm_medium": "string", "_utm_content": "string", "_utm_term": "string",
    "_gclid": "string", "_utm_campaign": "string", "_utm_source_platform": "string",
}
# Traffic source field -> the attribute used when the client did not set the field itself. Fixed values.
UTM_FALLBACK = {
    "source": "_utm_source", "medium": "_utm_medium", "campaign": "_utm_campaign", "content": "_utm_content",
    "term": "_utm_term", "campaign_id": "_utm_id", "clid_platform": "_utm_source_platform",
}
USER_SCHEMA = (
    "_user_id struct<value:string,set_timestamp:bigint>, _user_name struct<value:string,set_timestamp:bigint>, "
    "_user_age struct<value:bigint,set_timestamp:bigint>, "
    "_user_first_touch_timestamp struct<value:bigint,set_timestamp:bigint>"
)
# Names an event may carry at the top level that are no custom properties. Fixed values.
KNOWN_TOP_LEVEL = [f for f in EVENT_FIELDS if f != "_corrupt_record"]


def time_shift(df: DataFrame, now_msec: int | Column, enabled: bool = False) -> DataFrame:
    """Adds `time_diff`, `shifted` and the effective `event_msec` to entries with `e`.

    The clock difference is ingest minus upload time. It applies when it exceeds
    ten minutes (if enabled) or the event lies in the future; an event still in
    the future afterwards takes the ingest time.
    """
    now = F.lit(now_msec) if isinstance(now_msec, int) else now_msec
    at, ingest = F.col("e.timestamp"), F.col("ingest_time")
    from_uri = url.first_param(uri_pairs(), "upload_timestamp").try_cast("bigint")
    given = F.col("client_timestamp").try_cast("bigint") if "client_timestamp" in df.columns else F.lit(None).cast("bigint")
    upload, clock = F.col("upload_msec"), F.col("ingest_time") - F.col("upload_msec")
    applies = upload.isNotNull() & ((at > now) | (F.lit(enabled) & (F.abs(clock) > SHIFT_THRESHOLD_MSEC)))
    first = F.when(applies, clock).otherwise(F.lit(0))
    ahead = at + first > now
    return (
        df.withColumn("upload_msec", F.coalesce(given, from_uri))
        .withColumn("time_diff", F.when(ahead, ingest - at).otherwise(first).cast("bigint"))
        .withColumn("shifted", F.coalesce(applies | ahead, F.lit(False)))
        .withColumn("event_msec", at + F.col("time_diff"))
    )


def uri_pairs() -> Column:
    """Query parameters of the request path."""
    return url.pairs(F.nullif(F.substring_index(F.when(F.col("uri").contains("?"), F.col("uri")), "?", -1), F.lit("")))


def custom_params(event_json: Column, attributes_json: Column) -> Column:
    """Typed map of everything not reserved; attributes win over the event's own members."""
    top = typed(without(variant_map(event_json), [*KNOWN_TOP_LEVEL, "unique_id"]))
    own = typed(without(variant_map(attributes_json), list(ATTRIBUTES)))
    return merge(top, own)


def parse_events(entries: DataFrame, project_id: str = "project") -> DataFrame:
    """Flat event rows from clean entries (after `time_shift`).

    Conditional attributes: the first-time flag belongs to app starts, engagement
    time to user engagement, scroll and the view events.
    """
    attribute_schema = ", ".join(f"`{n}` {t}" for n, t in ATTRIBUTES.items())
    rows = entries.select(
        "*", F.from_json("e.attributes", attribute_schema).alias("a"),
        F.from_json("e.user", USER_SCHEMA).alias("usr"),
        uri_pairs().alias("_uri"),
    )
    e, a = (lambda n: F.col(f"e.{n}")), (lambda n: F.col(f"a.`{n}`"))
    name = F.coalesce(e("event_type"), F.lit("unknown"))
    only = lambda event, c: F.when(name == event, c)
    shift = lambda c: c + F.col("time_diff")
    pf = e("platform")
    page_url = a("_page_url")
    latest_host = F.coalesce(a("_latest_referrer_host"), url.host(a("_latest_referrer")))
    columns = {
        "event_timestamp": F.timestamp_millis("event_msec"),
        "event_id": e("event_id"),
        "event_time_msec": F.col("event_msec"),
        "event_name": name,
        "event_value": e("event_value"),
        "event_value_currency": F.when(e("event_value").isNotNull(), F.coalesce(e("event_value_currency"), F.lit("USD"))),
        "event_bundle_sequence_id": url.first_param(F.col("_uri"), "event_bundle_sequence_id").try_cast("bigint"),
        "ingest_time_msec": F.col("ingest_time"),
        "device_mobile_brand_name": e("brand"),
        "device_mobile_model_name": e("model"),
        "device_manufacturer": e("make"),
        "device_carrier": e("carrier"),
        "device_network_type": e("network_type"),
        "device_operating_system": F.when(F.lower(pf).isin("android", "ios", "wechatmp"), pf),
        "device_operating_system_version": e("os_version"),
        "device_vendor_id": e("device_id"),
        "device_advertising_id": e("device_unique_id"),
        "device_system_language": e("system_language"),
        "device_time_zone_offset_seconds": (e("zone_offset") / 1000).cast("int"),
        "device_screen_width": e("screen_width"),
        "device_screen_height": e("screen_height"),
        "device_viewport_width": e("viewport_width"),
        "device_viewport_height": e("viewport_height"),
        "geo_locale": e("locale"),
        "app_package_id": e("app_package_name"),
        "app_version": e("app_version"),
        "app_title": e("app_title"),
        "app_install_source": a("_app_install_channel"),
        "app_id": e("app_id"),
        "platform": F.coalesce(pf, F.lit("Web")),
        "project_id": F.lit(project_id),
        "screen_view_screen_name": a("_screen_name"),
        "screen_view_screen_id": a("_screen_id"),
        "screen_view_screen_unique_id": a("_screen_unique_id"),
        "screen_view_previous_screen_name": a("_previous_screen_name"),
        "screen_view_previous_screen_id": a("_previous_screen_id"),
        "screen_view_previous_screen_unique_id": a("_previous_screen_unique_id"),
        "screen_view_previous_time_msec": only("_screen_view", shift(a("_previous_timestamp"))),
        "screen_view_engagement_time_msec": only("_screen_view", a("_engagement_time_msec")),
        "screen_view_entrances": a("_entrances"),
        "page_view_page_referrer": url.decode(a("_page_referrer")),
        "page_view_page_referrer_title": url.decode(a("_page_referrer_title")),
        "page_view_previous_time_msec": only("_page_view", shift(a("_previous_timestamp"))),
        "page_view_engagement_time_msec": only("_page_view", a("_engagement_time_msec")),
        "page_view_page_title": url.decode(a("_page_title")),
        "page_view_page_url": url.decode(page_url),
        "page_view_page_url_path": url.path(page_url),
        "page_view_page_url_query_parameters": url.params(url.pairs(url.query(page_url))),
        "page_view_hostname": F.coalesce(e("host_name"), url.host(page_url)),
        "page_view_latest_referrer": url.decode(a("_latest_referrer")),
        "page_view_latest_referrer_host": latest_host,
        "page_view_entrances": a("_entrances"),
        "app_start_is_first_time": only(APP_START, a("_is_first_time")),
        "upgrade_previous_app_version": a("_previous_app_version"),
        "upgrade_previous_os_version": a("_previous_os_version"),
        "search_key": a("_search_key"),
        "search_term": a("_search_term"),
        "outbound_link_classes": a("_link_classes"),
        "outbound_link_domain": a("_link_domain"),
        "outbound_link_id": a("_link_id"),
        "outbound_link_url": a("_link_url"),
        "outbound_link": a("_outbound"),
        "user_engagement_time_msec": only(USER_ENGAGEMENT, a("_engagement_time_msec")),
        "user_first_touch_time_msec": shift(F.col("usr._user_first_touch_timestamp.value")),
        "user_pseudo_id": e("unique_id"),
        "user_id": F.col("usr._user_id.value"),
        "session_id": a("_session_id"),
        "session_start_time_msec": shift(a("_session_start_time_msec")),
        "session_duration": a("_session_duration"),
        "session_number": a("_session_number"),
        "scroll_engagement_time_msec": only(SCROLL, a("_engagement_time_msec")),
        "sdk_error_code": a("_error_code"),
        "sdk_error_message": a("_error_message"),
        "sdk_version": e("sdk_version"),
        "sdk_name": e("sdk_name"),
        "app_exception_message": a("_exception_message"),
        "app_exception_stack": a("_exception_stack"),
        "custom_parameters": custom_params(F.col("data"), e("attributes")),
        "ua": F.col("ua"),
        "ip": F.col("ip"),
        **{f"traffic_source_{f}": F.coalesce(a(f"_traffic_source_{f}"), a(utm)) for f, utm in UTM_FALLBACK.items()},
        "traffic_source_clid": F.coalesce(
            a("_traffic_source_clid"),
            F.when(a("_gclid").isNotNull(), F.to_json(F.struct(F.lit("gclid").alias("type"), a("_gclid").alias("value"))))),
        "traffic_source_channel_group": a("_traffic_source_channel_group"),
        "traffic_source_category": a("_traffic_source_category"),
        "process_info": _process_info(entries),
        # The parts of the payload other tables are cut from.
        "user_json": e("user"),
        "items_json": e("items"),
        "raw_page_url": page_url,
        "raw_page_referrer": a("_page_referrer"),
        "raw_latest_referrer": a("_latest_referrer"),
    }
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def _process_info(entries: DataFrame) -> Column:
    iso = lambda msec: F.date_format(F.timestamp_millis(msec), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    file = F.col("input_file_name") if "input_file_name" in entries.columns else F.lit(None).cast("string")
    shifted = F.col("shifted")
    return F.create_map(
        F.lit("rid"), F.col("rid"), F.lit("ingest_time"), iso(F.col("ingest_time")),
        F.lit("input_file_name"), file, F.lit("source_ip"), F.col("ip"),
        F.lit("upload_time"), iso(F.col("upload_msec")),
        F.lit("event_timestamp_adjusted"), F.when(shifted, F.lit("true")),
        F.lit("event_timestamp_adjusted_from"), F.when(shifted, F.col("e.timestamp").cast("string")),
        F.lit("event_timestamp_adjusted_to"), F.when(shifted, F.col("event_msec").cast("string")),
    )
