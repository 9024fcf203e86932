"""Shared parts of the query catalogue: input relations and output formatting.

A registered query returns plain columns (text, whole numbers, rounded doubles)
so that two engines can be compared value by value.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import adapt
from eventloom.operators.view import base_view, event_user_view
from eventloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame, digits: int = 8) -> DataFrame:
    """Dates and clocks as text, doubles rounded, decimals as doubles."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("long")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(prepare(spark), sf_dir))
    return run


def events(spark, sf):
    return adapt.events_view(spark, sf)


def facts(spark, sf):
    return adapt.with_session_facts(adapt.events_view(spark, sf))


def users(spark, sf):
    return adapt.users_view(spark, sf)


def sessions(spark, sf):
    return adapt.sessions_view(spark, sf)


def user_events(spark, sf):
    """Events with their user row."""
    return event_user_view(events(spark, sf), users(spark, sf))


def user_facts(spark, sf):
    return event_user_view(facts(spark, sf), users(spark, sf))


def full_view(spark, sf):
    """Events with session and user columns, the relation of the warehouse metrics."""
    return event_user_view(base_view(facts(spark, sf), sessions(spark, sf), unique=True), users(spark, sf))


# ---------------------------------------------------------------- oracle side

def pick(selector: str, values: list) -> str:
    cases = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values))
    return f"CASE {selector} {cases} END"


EV = f"""
ev0 AS (
  SELECT event_id AS n, user_id AS u, event_type AS kind, value AS val, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev AS (
  SELECT 'e' || n AS event_id, ts AS event_timestamp, epoch_us(ts) // 1000 AS event_time_msec,
    CASE WHEN kind = 'view' THEN CASE WHEN u % 3 = 0 THEN '_page_view' ELSE '_screen_view' END
         WHEN kind = 'click' THEN CASE WHEN k % 2 = 0 THEN '_session_start' ELSE '_click' END
         WHEN kind = 'signup' THEN '_first_open' WHEN kind = 'error' THEN '_app_exception'
         ELSE 'purchase' END AS event_name,
    'u' || u AS user_pseudo_id, CASE WHEN u % 4 <> 0 THEN 'm' || (u // 2) END AS user_id,
    'app' || (u % 2) AS app_id, {pick('u % 3', ['Web', 'Android', 'iOS'])} AS platform,
    u || '-' || strftime(ts, '%Y%m%d') AS session_id,
    CASE WHEN kind IN ('view','click') THEN CAST(round(val * 100) AS BIGINT) END AS user_engagement_time_msec,
    CASE WHEN kind = 'purchase' THEN val END AS event_value,
    CASE WHEN kind = 'view' AND u % 3 = 0 THEN 'title ' || (k % 20) END AS page_view_page_title,
    CASE WHEN kind = 'view' AND u % 3 = 0 THEN '/p/' || (k % 10) END AS page_view_page_url_path,
    CASE WHEN kind = 'view' AND u % 3 <> 0 THEN 'screen ' || (k % 20) END AS screen_view_screen_name,
    CASE WHEN kind = 'view' AND u % 3 <> 0 THEN 'sid' || (k % 10) END AS screen_view_screen_id,
    'NATION_' || (u % 25) AS geo_country, 'city' || (u % 7) AS geo_city, '1.' || (k % 4) AS app_version,
    CASE WHEN u % 3 <> 0 THEN 'model' || (u % 5) END AS device_mobile_model_name,
    {pick('u % 3', [None, 'Android', 'iOS'])} AS device_operating_system,
    CASE WHEN u % 3 <> 0 THEN 'v' || (u % 6) END AS device_operating_system_version,
    {pick('u % 4', ['Desktop', 'Phone', 'Pad', None])} AS device_ua_device,
    {pick('u % 3', ['Windows', 'Android', 'iOS'])} AS device_ua_os,
    {pick('u % 3', ['10', '14', '17'])} AS device_ua_os_version,
    {pick('u % 2', ['Chrome', 'Safari'])} AS device_ua_browser,
    {pick('u % 3', ['PC', 'Mobile', 'Tablet'])} AS device_ua_device_category,
    CASE WHEN u % 10 <> 0 THEN 1080 + u % 3 END AS device_screen_width,
    CASE WHEN u % 10 <> 0 THEN 1920 + u % 3 END AS device_screen_height,
    {pick('k % 5', [None, 'Direct', 'google', 'facebook', 'example.org'])} AS traffic_source_source,
    {pick('k % 3', [None, 'cpc', 'organic'])} AS traffic_source_medium,
    {pick('k % 4', [None, 'spring', 'summer', 'autumn'])} AS traffic_source_campaign,
    {pick('k % 2', [None, 'gclid'])} AS traffic_source_clid_platform,
    {pick('k % 5', [None, 'Direct', 'Paid Search', 'Organic Social', 'Referral'])} AS traffic_source_channel_group,
    {pick('k % 5', [None, 'Direct', 'Search', 'Social', 'Referral'])} AS traffic_source_category,
    {pick('u % 3', [None, 'play', 'appstore'])} AS app_install_source,
    k, kind, u, n, val, ts + INTERVAL 1 MINUTE AS created_time,
    {pick('u % 3', ['web', 'android', 'ios'])} AS sdk_name, '2.0' AS sdk_version,
    CAST(ts AS DATE) AS event_date
  FROM ev0),
"""

FACTS = """
evf AS (
  SELECT e.*, event_time_msec - min(event_time_msec) OVER (PARTITION BY session_id) AS session_duration,
    min(event_time_msec) OVER (PARTITION BY session_id) AS session_start_time_msec,
    CASE WHEN event_name IN ('_page_view','_screen_view') AND row_number() OVER (
      PARTITION BY session_id, event_name IN ('_page_view','_screen_view') ORDER BY event_timestamp) = 1
      THEN 'true' ELSE 'false' END AS page_view_entrances
  FROM ev e),
"""

USERS = """
us AS (
  SELECT user_pseudo_id, user_id AS latest_user_id, app_id AS u_app_id,
    traffic_source_source AS first_traffic_source, traffic_source_medium AS first_traffic_medium,
    traffic_source_campaign AS first_traffic_campaign,
    traffic_source_clid_platform AS first_traffic_clid_platform,
    traffic_source_channel_group AS first_traffic_channel_group,
    app_install_source AS first_app_install_source,
    event_time_msec - CASE WHEN u % 7 = 0 THEN 86400000 ELSE 0 END AS first_touch_time_msec
  FROM ev QUALIFY row_number() OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp) = 1),
"""

SESS = """
se AS (
  SELECT app_id, user_pseudo_id, session_id, event_timestamp, user_id, created_time,
    traffic_source_source AS session_source, traffic_source_medium AS session_medium,
    traffic_source_campaign AS session_campaign, traffic_source_clid_platform AS session_clid_platform,
    traffic_source_channel_group AS session_channel_group, traffic_source_category AS session_source_category
  FROM ev WHERE event_name IN ('_session_start','_page_view','_user_engagement','_screen_view','_app_end')
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY
    CASE WHEN coalesce(traffic_source_source, 'Direct') <> 'Direct' THEN 0 ELSE 1 END, event_timestamp) = 1),
"""

VIEW = """
vw AS (
  SELECT e.*, session_source, session_medium, session_campaign, session_clid_platform,
    session_channel_group, session_source_category,
    latest_user_id, first_touch_time_msec, first_traffic_source, first_traffic_medium,
    first_traffic_campaign, first_traffic_clid_platform, first_traffic_channel_group,
    first_app_install_source, coalesce(latest_user_id, e.user_pseudo_id) AS merged_user_id
  FROM evf e JOIN us USING (user_pseudo_id)
  LEFT JOIN se s ON s.user_pseudo_id = e.user_pseudo_id AND s.session_id = e.session_id),
"""

BASE = EV + FACTS + USERS + SESS + VIEW


def with_base(body: str, *extra: str) -> str:
    """`WITH` the shared relations (and extra ones) in front of a SELECT."""
    ctes = (BASE + "".join(e.strip().rstrip(",") + ",\n" for e in extra if e.strip())).strip().rstrip(",")
    return f"WITH {ctes}\n{body}"


def day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def clock(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def local(tz: str, column: str = "event_timestamp") -> str:
    """Wall clock of a zone for a UTC timestamp."""
    if tz == "UTC":
        return column
    return f"timezone('{tz}', timezone('UTC', {column}))"
