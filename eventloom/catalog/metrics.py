"""Metric tables: query and oracle per key."""

from __future__ import annotations

from eventloom.catalog import base as b
from eventloom.catalog.base import clock, day, local, with_base
from eventloom.operators.metrics import (
    acquisition, activity, behaviour, engagement, lifecycle, metadata, pages, retention,
)

TZ = "Asia/Shanghai"
VIEWS = "('_page_view','_screen_view')"

QUERIES: dict[str, b.Query] = {}
ORACLES: dict[str, str] = {}


def add(key: str, fn: b.Query, sql: str | None = None) -> None:
    QUERIES[key] = b.query(fn)
    if sql is not None:
        ORACLES[key] = sql


# ------------------------------------------------------------------ activity

_SUMMARY = f"""count(DISTINCT event_id) AS event_count,
  count(DISTINCT CASE WHEN event_name IN {VIEWS} THEN event_id END) AS view_count,
  count(DISTINCT user_pseudo_id) AS user_count, count(DISTINCT session_id) AS session_count"""

add("event_daily", lambda s, d: activity.event_daily(b.events(s, d)), with_base(f"""
SELECT app_id, {day('event_timestamp')} AS event_date, event_name, platform, geo_country, {_SUMMARY}
FROM ev GROUP BY ALL"""))

add("event_hourly", lambda s, d: activity.event_hourly(b.events(s, d)), with_base(f"""
SELECT app_id, {clock("date_trunc('hour', event_timestamp)")} AS event_hour, event_name, platform, geo_country,
  {_SUMMARY} FROM ev GROUP BY ALL"""))

for _key, _label, _unit in [("dau", "event_date", "day"), ("wau", "week_start", "week"),
                            ("mau", "month_start", "month")]:
    add(_key, lambda s, d, fn=getattr(activity, _key): fn(b.events(s, d)), with_base(f"""
SELECT app_id, {day(f"date_trunc('{_unit}', event_timestamp)")} AS {_label}, platform,
  count(DISTINCT user_pseudo_id) AS user_count FROM ev GROUP BY ALL"""))

add("active_user_list", lambda s, d: activity.active_user_list(b.user_events(s, d), TZ), with_base(f"""
SELECT DISTINCT app_id, {day(local(TZ))} AS event_date, platform, merged_user_id FROM vw"""))

_TOUCH = "CAST(epoch_ms(first_touch_time_msec) AS DATE)"
add("new_return", lambda s, d: activity.new_return(b.events(s, d), b.users(s, d)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform,
  CASE WHEN event_date = {_TOUCH} THEN 'NEW' ELSE 'RETURNING' END AS user_type,
  count(DISTINCT user_pseudo_id) AS user_count
FROM vw GROUP BY ALL"""))

add("new_return_first_open", lambda s, d: activity.new_return(b.events(s, d)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform,
  CASE WHEN opened THEN 'NEW' ELSE 'RETURNING' END AS user_type, count(*) AS user_count
FROM (SELECT app_id, event_date, platform, user_pseudo_id, bool_or(event_name = '_first_open') AS opened
      FROM ev GROUP BY ALL) GROUP BY ALL"""))

add("new_return_tz", lambda s, d: activity.new_return_tz(b.user_events(s, d), TZ), with_base(f"""
SELECT app_id, {day(local(TZ))} AS event_date, platform,
  CASE WHEN CAST({local(TZ)} AS DATE) = CAST({local(TZ, 'epoch_ms(first_touch_time_msec)')} AS DATE)
    THEN 'NEW' ELSE 'RETURNING' END AS user_type, count(DISTINCT merged_user_id) AS user_count
FROM vw GROUP BY ALL"""))

add("user_view_count", lambda s, d: activity.user_view_count(b.user_events(s, d)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, merged_user_id AS active_users,
  count(DISTINCT CASE WHEN event_name = '_first_open' THEN user_pseudo_id END) AS new_users,
  count(DISTINCT CASE WHEN event_name IN {VIEWS} THEN event_id END) AS view_count
FROM vw GROUP BY ALL"""))

add("intraday_users", lambda s, d: activity.intraday_users(b.user_events(s, d), TZ), with_base(f"""
SELECT DISTINCT app_id, {clock(f"date_trunc('hour', {local(TZ)})")} AS event_date, platform,
  merged_user_id AS active_users, CASE WHEN event_name = '_first_open' THEN merged_user_id END AS new_users
FROM vw"""))

add("day_event_view", lambda s, d: activity.day_event_view(b.events(s, d), TZ), with_base(f"""
SELECT app_id, {day(local(TZ))} AS event_date, platform, count(DISTINCT event_id) AS event_count,
  count(DISTINCT CASE WHEN event_name IN {VIEWS} THEN event_id END) AS view_count
FROM ev GROUP BY ALL"""))

add("event_overtime", lambda s, d: activity.event_overtime(b.events(s, d), TZ), with_base(f"""
SELECT app_id, {day(local(TZ))} AS event_date, platform, count(DISTINCT event_id) AS event_count
FROM ev GROUP BY ALL"""))

# ---------------------------------------------------------------- engagement

_SES = f"""
ses AS (
  SELECT app_id, session_id, user_pseudo_id, merged_user_id, platform, ld AS event_date,
    min(event_timestamp) AS t0, max(event_timestamp) AS t1, count(*) AS n,
    count(*) FILTER (event_name IN {VIEWS}) AS views,
    sum(coalesce(user_engagement_time_msec, 0)) AS msec, max(session_duration) AS dur,
    CASE WHEN count(*) FILTER (event_name IN {VIEWS}) > 1 OR max(session_duration) > 10000
      THEN 1 ELSE 0 END AS engaged
  FROM (SELECT *, CAST(@LOCAL@ AS DATE) AS ld FROM vw) GROUP BY ALL),"""
_SES_UTC, _SES_TZ = _SES.replace("@LOCAL@", local("UTC")), _SES.replace("@LOCAL@", local(TZ))

add("session_analysis", lambda s, d: engagement.session_analysis(b.facts(s, d)), with_base(f"""
SELECT app_id, session_id, user_pseudo_id, platform, {day('event_date')} AS event_date,
  {clock('t0')} AS session_start_time, {clock('t1')} AS session_end_time, n AS events_count,
  views AS view_count, CAST(msec AS BIGINT) AS user_engagement_time_msec, CAST(dur AS BIGINT) AS session_duration,
  engaged AS engaged_session, engaged = 0 AS bounce_flag FROM ses""", _SES_UTC))

_KPI = """
  round({s} / {u}, 8) AS avg_engaged_session_per_user,
  round(CASE WHEN {s} > 0 THEN {m} / {s} / 1000 ELSE 0 END, 8) AS avg_engagement_time_per_session_seconds,
  round({m} / {u} / 1000, 8) AS avg_engagement_time_per_user_seconds"""
_ENG_MSEC = "sum(CASE WHEN engaged = 1 THEN msec ELSE 0 END)"

add("engagement_kpi", lambda s, d: engagement.engagement_kpi(b.facts(s, d)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, count(DISTINCT user_pseudo_id) AS total_users,
  CAST(sum(engaged) AS BIGINT) AS engaged_sessions, CAST({_ENG_MSEC} AS BIGINT) AS total_engagement_time_msec,
  {_KPI.format(s='CAST(sum(engaged) AS DOUBLE)', u='count(DISTINCT user_pseudo_id)', m=f'CAST({_ENG_MSEC} AS DOUBLE)')}
FROM ses GROUP BY app_id, ses.event_date, platform""", _SES_UTC))

add("engagement_kpi_tz", lambda s, d: engagement.engagement_kpi_tz(b.user_facts(s, d), TZ), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform,
  {_KPI.format(s='CAST(sum(engaged) AS DOUBLE)', u='count(DISTINCT merged_user_id)', m=f'CAST({_ENG_MSEC} AS DOUBLE)')}
FROM (SELECT app_id, event_date, platform, session_id, merged_user_id, sum(msec) AS msec,
        CASE WHEN sum(views) > 1 OR max(dur) > 10000 THEN 1 ELSE 0 END AS engaged FROM ses GROUP BY ALL) q
GROUP BY app_id, q.event_date, platform""", _SES_TZ))

# ----------------------------------------------------------------- behaviour

add("user_behavior", lambda s, d: behaviour.user_behavior(b.events(s, d)), with_base(f"""
SELECT app_id, user_id, user_pseudo_id, {day('min(event_date)')} AS first_visit_date,
  {day('max(event_date)')} AS last_visit_date, count(DISTINCT session_id) AS total_sessions,
  count(*) AS total_events, round(sum(coalesce(event_value, 0)), 8) AS ltv FROM ev GROUP BY ALL"""))

add("event_name", lambda s, d: behaviour.event_name(b.user_events(s, d), "merged_user_id"), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, merged_user_id AS user_id, event_name,
  count(DISTINCT event_id) AS event_count, round(sum(coalesce(event_value, 0)), 8) AS event_value
FROM vw GROUP BY ALL"""))

_DEVICE = """coalesce(device_mobile_model_name, device_ua_device) AS device, app_version,
  coalesce(device_operating_system, device_ua_os, 'null') AS operating_system,
  coalesce(device_operating_system_version, device_ua_os_version, 'null') AS operating_system_version,
  device_ua_browser, coalesce(CAST(device_screen_width AS VARCHAR), '') || ' x ' ||
    coalesce(CAST(device_screen_height AS VARCHAR), '') AS device_screen_resolution,
  device_ua_device, device_ua_device_category"""
add("device_usage", lambda s, d: behaviour.device_usage(b.events(s, d)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, user_pseudo_id AS user_id, platform, {_DEVICE},
  count(DISTINCT event_id) AS event_count FROM ev GROUP BY ALL"""))
add("device_cols", lambda s, d: behaviour.device_cols(b.events(s, d)).select(
    "event_id", *behaviour.DEVICE_COLUMNS), with_base(f"SELECT event_id, {_DEVICE} FROM ev"))

add("geo_new_user", lambda s, d: behaviour.geo_new_user(b.events(s, d)), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, geo_country, geo_city,
  count(DISTINCT CASE WHEN event_name = '_first_open' THEN user_pseudo_id END) AS user_count
FROM ev GROUP BY app_id, ev.event_date, platform, geo_country, geo_city HAVING user_count > 0"""))

add("crash_rate", lambda s, d: behaviour.crash_rate(behaviour.crash_rows(b.events(s, d))), with_base(f"""
SELECT app_id, {day('event_date')} AS event_date, platform, app_version, count(DISTINCT user_pseudo_id) AS users,
  count(DISTINCT CASE WHEN event_name = '_app_exception' THEN user_pseudo_id END) AS crashed_users,
  round(count(DISTINCT CASE WHEN event_name = '_app_exception' THEN user_pseudo_id END)
    / CAST(count(DISTINCT user_pseudo_id) AS DOUBLE), 8) AS crash_rate
FROM ev GROUP BY app_id, ev.event_date, platform, app_version"""))
add("crash_rows", lambda s, d: behaviour.crash_rows(b.user_events(s, d), "merged_user_id", TZ), with_base(f"""
SELECT DISTINCT app_id, {day(local(TZ))} AS event_date, platform, app_version, merged_user_id AS user_id,
  CASE WHEN event_name = '_app_exception' THEN merged_user_id END AS crashed_user_id FROM vw"""))

# ----------------------------------------------------------------- retention

_RET = f"""
act AS (SELECT DISTINCT app_id, user_pseudo_id, platform, event_date AS d, {_TOUCH} AS first_date FROM vw),
rb AS (SELECT *, datediff('day', first_date, d) AS diff FROM act WHERE datediff('day', first_date, d) BETWEEN 0 AND 42),
rf AS (SELECT * FROM rb WHERE NOT EXISTS (SELECT 1 FROM (
  SELECT platform, user_pseudo_id FROM rb GROUP BY ALL HAVING min(diff) > 0) x
  WHERE x.platform = rb.platform AND x.user_pseudo_id = rb.user_pseudo_id)),
co AS (SELECT app_id, platform, first_date, count(DISTINCT user_pseudo_id) AS total FROM rf WHERE diff = 0 GROUP BY ALL),"""
add("retention_daily", lambda s, d: retention.retention_daily(b.events(s, d), b.users(s, d)), with_base(f"""
SELECT rf.app_id, rf.platform, {day('rf.first_date')} AS cohort_date, diff AS day_number, total AS cohort_users,
  count(DISTINCT user_pseudo_id) AS retained_users,
  round(count(DISTINCT user_pseudo_id) / CAST(total AS DOUBLE), 8) AS retention_rate
FROM rf JOIN co USING (app_id, platform, first_date) GROUP BY rf.app_id, rf.platform, rf.first_date, diff, total""",
    _RET))

_RETW = """
wk AS (SELECT DISTINCT app_id, user_pseudo_id, platform, CAST(date_trunc('week', event_timestamp) AS DATE) AS w,
  CAST(date_trunc('week', epoch_ms(first_touch_time_msec)) AS DATE) AS fw FROM vw),
wb AS (SELECT *, datediff('day', fw, w) // 7 AS num FROM wk WHERE datediff('day', fw, w) // 7 BETWEEN 0 AND 12),
wc AS (SELECT app_id, platform, fw, count(DISTINCT user_pseudo_id) AS total FROM wb WHERE num = 0 GROUP BY ALL),"""
add("retention_weekly", lambda s, d: retention.retention_weekly(b.events(s, d), b.users(s, d)), with_base(f"""
SELECT wb.app_id, wb.platform, {day('wb.fw')} AS cohort_date, num AS week_number, total AS cohort_users,
  count(DISTINCT user_pseudo_id) AS retained_users,
  round(count(DISTINCT user_pseudo_id) / CAST(total AS DOUBLE), 8) AS retention_rate
FROM wb JOIN wc USING (app_id, platform, fw) GROUP BY wb.app_id, wb.platform, wb.fw, num, total""", _RETW))

_RB = f"""
rbw AS (SELECT DISTINCT app_id, user_pseudo_id, platform,
  CAST({local(TZ, 'epoch_ms(first_touch_time_msec // 1000 * 1000)')} AS DATE) AS first_date,
  datediff('day', CAST({local(TZ, 'epoch_ms(first_touch_time_msec // 1000 * 1000)')} AS DATE),
    CAST({local(TZ)} AS DATE)) AS day_diff
  FROM vw WHERE event_timestamp >= epoch_ms(first_touch_time_msec // 1000 * 1000)
  AND datediff('day', CAST({local(TZ, 'epoch_ms(first_touch_time_msec // 1000 * 1000)')} AS DATE),
    CAST({local(TZ)} AS DATE)) <= 42),
rk AS (SELECT * FROM rbw WHERE (platform, user_pseudo_id) NOT IN (
  SELECT (platform, user_pseudo_id) FROM rbw GROUP BY platform, user_pseudo_id HAVING min(day_diff) > 0)),"""
add("retention_base", lambda s, d: retention.retention_base(b.user_events(s, d), TZ), with_base(
    f"SELECT app_id, user_pseudo_id, platform, {day('first_date')} AS first_date, day_diff FROM rbw", _RB))
add("retention_view", lambda s, d: retention.retention_view(retention.retention_base(b.user_events(s, d), TZ)),
    with_base(f"""
SELECT r.app_id, r.platform, {day('r.first_date')} AS first_date, day_diff,
  count(DISTINCT user_pseudo_id) AS returned_user_count, total_users
FROM rk r JOIN (SELECT app_id, platform, first_date, count(DISTINCT user_pseudo_id) AS total_users FROM rk GROUP BY ALL) t
  USING (app_id, platform, first_date) GROUP BY r.app_id, r.platform, r.first_date, day_diff, total_users""", _RB))

# --------------------------------------------------------------------- pages

def _dims(select: str, source: str, where: str = "TRUE", own: bool = False, null_ok: bool = False) -> str:
    """UNION ALL of one branch per dimension, as separate scans."""
    parts = []
    for label, column, event in pages.DIMENSIONS:
        cond = where + (f" AND event_name = '{event}'" if own else "") + ("" if null_ok else f" AND {column} IS NOT NULL")
        parts.append(f"SELECT *, '{label}' AS aggregation_type, {column} AS aggregation_dim, '{event}' AS own "
                     f"FROM {source} WHERE {cond}")
    return f"SELECT {select} FROM ({' UNION ALL '.join(parts)}) q"


_PK = f"app_id, {day('event_date')} AS event_date, platform, aggregation_type, aggregation_dim"
_GB = " GROUP BY app_id, q.event_date, platform, aggregation_type, aggregation_dim"
add("page_view", lambda s, d: pages.page_view(b.events(s, d)), with_base(
    _dims(f"{_PK}, count(DISTINCT event_id) AS view_count", "ev", f"event_name IN {VIEWS}") + _GB))
_OWN = "count(DISTINCT CASE WHEN event_name = own THEN event_id END) AS view_count"
add("page_view_wh", lambda s, d: pages.page_view_tz(b.events(s, d)), with_base(
    _dims(f"{_PK}, {_OWN}", "ev", null_ok=True) + _GB))
add("page_view_detail", lambda s, d: pages.page_view_detail(b.user_events(s, d)), with_base(
    _dims(f"{_PK}, merged_user_id AS user_id, round(CAST(sum(user_engagement_time_msec) AS DOUBLE) / 1000, 8) "
          f"AS user_engagement_time_seconds, count(DISTINCT event_id) AS event_count, {_OWN}, "
          "count(DISTINCT session_id) AS session_count", "vw", null_ok=True) + _GB + ", merged_user_id"))
add("entrance", lambda s, d: pages.entrance(b.facts(s, d)), with_base(
    _dims(f"{_PK}, count(DISTINCT event_id) AS entrance_count", "evf", "page_view_entrances = 'true'", own=True) + _GB))
_LAST = f"""
lst AS (SELECT * FROM ev WHERE event_name IN {VIEWS}
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC) = 1),"""
add("exit_page", lambda s, d: pages.exit_page(b.events(s, d)), with_base(
    _dims(f"{_PK}, count(session_id) AS exit_count", "lst", own=True) + _GB, _LAST))


def _exit_wh() -> str:
    parts = []
    for label, column, event in pages.DIMENSIONS:
        parts.append(f"""SELECT app_id, {day('event_date')} AS event_date, platform, '{label}' AS aggregation_type,
  {column} AS aggregation_dim, count(*) AS exit_count FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id, event_date ORDER BY event_timestamp DESC) AS rk
    FROM ev WHERE event_name = '{event}' AND {column} IS NOT NULL) z WHERE rk = 1
  GROUP BY app_id, z.event_date, platform, {column}""")
    return " UNION ALL ".join(parts)


add("exit_page_wh", lambda s, d: pages.exit_page_tz(b.events(s, d)), with_base(_exit_wh()))

# --------------------------------------------------------------- acquisition

_TOT = """CAST(sum(newu) AS BIGINT) AS new_user_count, count(session_id) AS session_count,
  CAST(sum(hit) AS BIGINT) AS {es}, round(CASE WHEN sum(n) > 0 THEN CAST(sum(hit) AS DOUBLE) / sum(n) ELSE 0 END, 8)
    AS engagement_rate,
  round(CASE WHEN count(session_id) > 0 THEN CAST(sum(hit) AS DOUBLE) / count(session_id) ELSE 0 END, 8)
    AS engaged_session_rate, CAST(sum(n) AS BIGINT) AS event_count"""
_HITM = "sum(CASE WHEN hit = 1 THEN msec ELSE 0 END)"
_ACQ = f"""
aq AS (SELECT *, CASE WHEN views > 1 OR dur > 10000 THEN 1 ELSE 0 END AS hit FROM (
  SELECT app_id, event_date, platform, session_id, user_pseudo_id, traffic_source_source s1, traffic_source_medium s2,
    traffic_source_campaign s3, traffic_source_clid_platform s4, traffic_source_channel_group s5,
    any_value(first_traffic_source) f1, any_value(first_traffic_medium) f2, any_value(first_traffic_campaign) f3,
    any_value(first_traffic_channel_group) f5, any_value(first_app_install_source) f6,
    count(DISTINCT event_id) AS n, count(*) FILTER (event_name IN {VIEWS}) AS views, max(session_duration) AS dur,
    sum(coalesce(user_engagement_time_msec, 0)) AS msec, max(CASE WHEN event_name = '_first_open' THEN 1 ELSE 0 END) AS newu
  FROM vw GROUP BY ALL)),"""
_ACQ_DIMS = [("Session Traffic Source", "s1"), ("Session Traffic Medium", "s2"),
             ("Session Traffic Source / Medium", "concat_ws(' / ', s1, s2)"), ("Session Traffic Campaign", "s3"),
             ("Session Traffic Channel Group", "s5"), ("User First Traffic Source", "f1"),
             ("User First Traffic Medium", "f2"), ("User First Traffic Source / Medium", "concat_ws(' / ', f1, f2)"),
             ("User First Traffic Campaign", "f3"), ("User First Traffic Channel Group", "f5"),
             ("App First Install Source", "f6")]
add("acquisition", lambda s, d: acquisition.acquisition(b.facts(s, d), b.users(s, d)), with_base(
    " UNION ALL ".join(f"""
SELECT app_id, {day('event_date')} AS event_date, '{label}' AS aggregation_type, {dim} AS aggregation_dim, platform,
  user_pseudo_id, {_TOT.format(es='engaged_session_count')}, CAST({_HITM} AS BIGINT) AS total_engagement_time_msec,
  round(CASE WHEN sum(hit) > 0 THEN CAST({_HITM} AS DOUBLE) / sum(hit) / 1000 ELSE 0 END, 8) AS avg_engagement_time_seconds
FROM aq GROUP BY app_id, aq.event_date, {dim}, platform, user_pseudo_id""" for label, dim in _ACQ_DIMS), _ACQ))

_ACQW = f"""
t1 AS (SELECT app_id, CAST({local(TZ)} AS DATE) AS d, merged_user_id, session_id, count(DISTINCT event_id) AS n,
    CASE WHEN count(*) FILTER (event_name IN {VIEWS}) > 1 OR max(session_duration) > 10000
      OR sum(user_engagement_time_msec) > 10000000 THEN 1 ELSE 0 END AS hit,
    sum(user_engagement_time_msec) AS msec,
    max(CASE WHEN event_name = '_first_open' THEN 1 ELSE 0 END) AS newu FROM vw GROUP BY ALL),
t2 AS (SELECT app_id, CAST({local(TZ)} AS DATE) AS d, session_id, platform, merged_user_id,
    max(first_traffic_source) f1, max(first_traffic_medium) f2, max(first_traffic_campaign) f3,
    max(first_traffic_clid_platform) f4, max(first_traffic_channel_group) f5, max(first_app_install_source) f6,
    max(session_source) s1, max(session_medium) s2, max(session_campaign) s3, max(session_clid_platform) s4,
    max(session_channel_group) s5 FROM vw GROUP BY ALL),
tj AS (SELECT t2.*, t1.n, t1.hit, t1.msec, t1.newu FROM t2 JOIN t1 USING (app_id, d, merged_user_id, session_id)),"""
_DIMS13 = [("User First Traffic Source", "f1"), ("User First Traffic Source / Medium", "f1 || ' / ' || f2"),
           ("User First Traffic Medium", "f2"), ("User First Traffic Campaign", "f3"),
           ("User First Traffic Clid Platform", "f4"), ("User First Traffic Channel Group", "f5"),
           ("App First Install Source", "f6"), ("Session Traffic Source", "s1"), ("Session Traffic Medium", "s2"),
           ("Session Traffic Source / Medium", "s1 || ' / ' || s2"), ("Session Traffic Campaign", "s3"),
           ("Session Traffic Clid Platform", "s4"), ("Session Traffic Channel Group", "s5")]
add("acquisition_wh", lambda s, d: acquisition.acquisition_tz(b.full_view(s, d), TZ), with_base(
    " UNION ALL ".join(f"""
SELECT app_id, {day('d')} AS event_date, '{label}' AS aggregation_type, {dim} AS aggregation_dim, platform,
  merged_user_id AS user_id, {_TOT.format(es='engagement_session_count')},
  round(CAST({_HITM} AS DOUBLE) / 1000, 8) AS total_user_engagement_time_seconds,
  round(CAST({_HITM} AS DOUBLE) / 1000 / greatest(sum(hit), 1), 8) AS avg_user_engagement_time_seconds
FROM tj GROUP BY app_id, d, {dim}, platform, merged_user_id""" for label, dim in _DIMS13), _ACQW))

_LONG = {"f1": "first_traffic_source", "f2": "first_traffic_medium", "f3": "first_traffic_campaign",
         "f4": "first_traffic_clid_platform", "f5": "first_traffic_channel_group", "f6": "first_app_install_source",
         "s1": "session_source", "s2": "session_medium", "s3": "session_campaign", "s4": "session_clid_platform",
         "s5": "session_channel_group"}


def _long(dim: str) -> str:
    for short, name in _LONG.items():
        dim = dim.replace(short, name)
    return dim


add("traffic_users", lambda s, d: acquisition.traffic_users(b.full_view(s, d)), with_base(" UNION ALL ".join(f"""
SELECT DISTINCT app_id, {day('event_date')} AS event_date, platform, '{label}' AS aggregation_type,
  {_long(dim)} AS aggregation_dim, merged_user_id AS user_id FROM vw
  {"WHERE event_name = '_first_open'" if dim[0] == 'f' else ''}""" for label, dim in _DIMS13)))

# ----------------------------------------------------------------- lifecycle

add("lifecycle_weekly", lambda s, d: lifecycle.lifecycle_weekly(b.events(s, d)), with_base(f"""
SELECT app_id, {day("date_trunc('week', event_timestamp)")} AS time_period_week, platform,
  count(DISTINCT user_pseudo_id) AS user_count FROM ev WHERE event_name = '_session_start' GROUP BY ALL"""))

_LIFE = f"""
lw AS (SELECT DISTINCT app_id, user_pseudo_id, platform, CAST(date_trunc('week', {local(TZ)}) AS DATE) AS w
  FROM ev WHERE event_name = '_session_start'),
ll AS (SELECT *, lag(w) OVER o AS lg, lead(w) OVER o AS ld FROM lw
  WINDOW o AS (PARTITION BY app_id, user_pseudo_id ORDER BY w, platform)),
st AS (SELECT *, CASE WHEN lg IS NULL THEN '1-NEW' WHEN datediff('day', lg, w) / 7 = 1 THEN '2-RETAINED-ACTIVE'
    WHEN datediff('day', lg, w) / 7 > 1 THEN '3-RETURN' END AS state,
  CASE WHEN datediff('day', w, ld) / 7 = 1 THEN NULL ELSE '0-CHURN' END AS churn FROM ll),"""
add("lifecycle_state", lambda s, d: lifecycle.lifecycle_state(b.events(s, d), TZ), with_base(f"""
SELECT app_id, {day('w')} AS time_period, platform, state AS this_week_value, CAST(count(*) AS BIGINT) AS sum
FROM st GROUP BY app_id, w, platform, state
UNION ALL SELECT app_id, {day('w + 7')}, platform, '0-CHURN', CAST(-count(*) AS BIGINT)
FROM st WHERE churn IS NOT NULL GROUP BY app_id, w, platform""", _LIFE))

# ------------------------------------------------------------------ metadata

_PRESETS = {"geo_country": ("event_outer", "string"), "app_version": ("event_outer", "string"),
            "page_view_page_title": ("event_outer", "string"), "screen_view_screen_name": ("event_outer", "string")}
_META = "pr AS (" + " UNION ALL ".join(
    f"SELECT app_id, event_timestamp, platform, 'event_outer' AS category, '{c}' AS property_name, "
    f"{c} AS property_value, 'string' AS value_type, '' AS event_name FROM ev" for c in _PRESETS) + """
  UNION ALL SELECT app_id, event_timestamp, platform, 'event', 'k', CAST(k AS VARCHAR), 'number', event_name FROM ev
  UNION ALL SELECT app_id, event_timestamp, platform, 'event', 'kind', kind, 'string', event_name FROM ev),
pc AS (SELECT app_id, category, '#' || strftime(event_timestamp, '%Y%m') AS month,
    CAST(day(event_timestamp) AS BIGINT) AS day_number, property_name, property_value, value_type, platform, event_name,
    count(*) AS n FROM pr WHERE property_value IS NOT NULL AND property_value <> '' GROUP BY ALL),
px AS (SELECT *, row_number() OVER (PARTITION BY app_id, category, month, day_number, value_type, property_name,
    platform, event_name ORDER BY n DESC, property_value) AS rk FROM pc),"""
add("meta_event_params", lambda s, d: metadata.event_parameters(b.events(s, d), _PRESETS, 5, metadata.WIDE_LIMITS), with_base("""
SELECT app_id, category, month, day_number, property_name, property_value, value_type, CAST(sum(n) AS BIGINT) AS count,
  string_agg(DISTINCT platform, '#|!|#' ORDER BY platform) AS platform,
  string_agg(DISTINCT event_name, '#|!|#' ORDER BY event_name) AS event_name_set
FROM px WHERE rk <= 5 OR (rk <= 50 AND property_name IN ('page_view_page_title','page_view_page_url',
  'screen_view_screen_name','screen_view_screen_id'))
GROUP BY app_id, category, month, day_number, property_name, property_value, value_type""", _META))

_UCOLS = ["user_id", "first_traffic_source", "first_traffic_medium", "first_app_install_source", "first_touch_time_msec"]
_UMETA = "ua AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS property_name, CAST({c.replace('user_id', 'latest_user_id')} AS VARCHAR) AS property_value FROM us"
    for c in _UCOLS) + """),
uc AS (SELECT property_name, property_value, count(*) AS n FROM ua
  WHERE property_value IS NOT NULL AND property_value <> '' AND property_name NOT LIKE '%timestamp%' GROUP BY ALL),
ux AS (SELECT *, row_number() OVER (PARTITION BY property_name ORDER BY n DESC, property_value) AS rk FROM uc),"""
add("meta_user_attrs", lambda s, d: metadata.user_attributes(
    metadata.user_attribute_rows(b.users(s, d), _UCOLS), 10), with_base("""
SELECT 'user_outer' AS category, property_name, 'string' AS value_type,
  string_agg(property_value || '_' || n, '#|!|#' ORDER BY property_value) AS value_enum
FROM ux WHERE rk <= 10 GROUP BY property_name""", _UMETA))

add("meta_events", lambda s, d: metadata.event_catalogue(b.events(s, d)), with_base("""
SELECT app_id, event_name, '#' || strftime(event_timestamp, '%Y%m') AS month,
  CAST(day(event_timestamp) AS BIGINT) AS day_number, count(*) AS count,
  string_agg(DISTINCT platform, '#|!|#' ORDER BY platform) AS platform,
  string_agg(DISTINCT sdk_version, '#|!|#' ORDER BY sdk_version) AS sdk_version,
  string_agg(DISTINCT sdk_name, '#|!|#' ORDER BY sdk_name) AS sdk_name
FROM ev GROUP BY ALL"""))
