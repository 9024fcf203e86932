"""Ad-hoc analyses: query and oracle per key. Oracles join and rank naively."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from eventloom.catalog import base as b
from eventloom.catalog.base import clock, day, local, with_base
from eventloom.functions.conditions import compile_conditions, property_column
from eventloom.functions.timeunits import date_units, in_scope
from eventloom.operators.explore import attribution as at
from eventloom.operators.explore import base as eb
from eventloom.operators.explore import funnel as fu
from eventloom.operators.explore import path as pa
from eventloom.operators.explore import retention as re_
from eventloom.operators.explore.model import (
    AGGREGATION_PROPERTY, COUNT_PROPERTY, EVENT, EVENT_CNT, SUM_VALUE, Attribute, AttributionQuery, Condition,
    Conditions, EventQuery, FunnelQuery, Grouping, PathQuery, Query, RetentionPair, RetentionQuery, Scope, Step,
)

TZ = "Asia/Shanghai"
QUERIES: dict[str, b.Query] = {}
ORACLES: dict[str, str] = {}

K = Attribute("k", EVENT, "int")
KIND = Attribute("kind", EVENT)
PLATFORM = Attribute("platform")
COUNTRY = Attribute("geo_country")
CITY = Attribute("geo_city")
TITLE = Attribute("page_view_page_title")
SCOPE = Scope.days("2024-01-03", "2024-01-20")
MONTH = Scope.days("2024-01-01", "2024-01-31")
NOW = dt.datetime(2024, 1, 25, 13, 30, tzinfo=dt.timezone.utc)


def add(key: str, fn: b.Query, sql: str | None = None) -> None:
    QUERIES[key] = b.query(fn)
    if sql is not None:
        ORACLES[key] = sql


def bounds(start: str, end: str, tz: str = "UTC") -> str:
    stop = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    at_ = lambda d: f"timezone('UTC', timezone('{tz}', TIMESTAMP '{d}'))"
    return f"event_timestamp >= {at_(start)} AND event_timestamp <= {at_(stop)}"


def units(tz: str) -> str:
    at_ = local(tz)
    return f"""strftime({at_}, '%Y-%m') AS month, strftime(date_trunc('week', {at_}), '%Y-%m-%d') AS week,
  strftime({at_}, '%Y-%m-%d') AS day, strftime({at_}, '%Y-%m-%d %H:00') AS hour"""


def picked(names: list[str] | None, start: str, end: str, tz: str = "UTC", where: str = "TRUE",
       user: str = "merged_user_id") -> str:
    listed = "TRUE" if names is None else "event_name IN (" + ",".join(f"'{n}'" for n in names) + ")"
    return f"""
picked AS (SELECT event_id, event_name, event_timestamp, {user} AS user_pseudo_id, user_id, session_id, k, kind, platform,
  geo_country, geo_city, event_value, page_view_page_title, page_view_page_url_path, screen_view_screen_name,
  screen_view_screen_id, {units(tz)} FROM vw
  WHERE {bounds(start, end, tz)} AND {listed} AND ({where})),"""


# ------------------------------------------------- conditions, scopes, units

def filtered(conditions: Conditions):
    return lambda s, d: b.events(s, d).where(compile_conditions(conditions)).select("event_id")


def _c(attribute, op, *values):
    return Condition(attribute, op, values)


add("cond_and_or", filtered(Conditions((_c(PLATFORM, "=", "Web"), _c(K, ">", 90), _c(CITY, "in", "city1", "city2")), "or")),
    with_base("SELECT event_id FROM ev WHERE platform = 'Web' OR k > 90 OR geo_city IN ('city1','city2')"))
add("cond_string", filtered(Conditions((
    _c(TITLE, "not_contains", "e_1"), _c(COUNTRY, "contains", "TION_1"), _c(PLATFORM, "<>", "iOS"),
    _c(Attribute("traffic_source_source"), "not_in", "google", "facebook"), _c(CITY, ">=", "city2"),
    _c(Attribute("event_name"), "is_not_null")))), with_base("""
SELECT event_id FROM ev WHERE (page_view_page_title IS NULL OR NOT contains(page_view_page_title, 'e_1'))
  AND contains(geo_country, 'TION_1') AND (platform IS NULL OR platform <> 'iOS')
  AND (traffic_source_source IS NULL OR traffic_source_source NOT IN ('google','facebook')) AND geo_city >= 'city2'"""))
add("cond_number", filtered(Conditions((
    _c(K, ">=", 10), _c(K, "not_in", 20, 30), _c(Attribute("event_value", data_type="double"), "<>", 5.0),
    _c(K, "<", 80)))), with_base("""
SELECT event_id FROM ev WHERE k >= 10 AND k NOT IN (20, 30) AND (event_value IS NULL OR event_value <> 5.0) AND k < 80"""))
_FLAG = Attribute("page_view_entrances", data_type="boolean")
add("cond_bool", lambda s, d: b.facts(s, d).where(compile_conditions(Conditions((_c(_FLAG, "true"),))))
    .select("event_id"), with_base("SELECT event_id FROM evf WHERE page_view_entrances = 'true'"))
add("property_project", lambda s, d: b.events(s, d).select("event_id", *[
    property_column(a).alias(a.column_name) for a in
    (K, KIND, Attribute("kind", EVENT, "double"), COUNTRY, Attribute("event_value", data_type="double"))][:2],
    property_column(Attribute("kind", EVENT, "double")).alias("e_kind_number"),
    property_column(COUNTRY).alias("geo_country")), with_base("""
SELECT event_id, CAST(k AS BIGINT) AS e_k, kind AS e_kind, CAST(NULL AS DOUBLE) AS e_kind_number, geo_country FROM ev"""))
add("scope_fixed", lambda s, d: b.events(s, d).where(in_scope(SCOPE, TZ)).select("event_id", "event_timestamp"),
    with_base(f"SELECT event_id, {clock('event_timestamp')} AS event_timestamp FROM ev "
              f"WHERE {bounds('2024-01-03', '2024-01-20', TZ)}"))


def _relative(s, d):
    parts = None
    for n, unit in [(10, "DD"), (2, "WK"), (1, "MM"), (1, "YY")]:
        part = b.events(s, d).where(in_scope(Scope.last(n, unit, NOW), "America/New_York")).groupBy().agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(f"{n} {unit}").alias("scope"), "n")
        parts = part if parts is None else parts.unionByName(part)
    return parts


# 13:30 UTC is 08:30 in New York: the day starts at 05:00 UTC.
add("scope_relative", _relative, with_base(" UNION ALL ".join(
    f"SELECT '{label}' AS scope, count(*) AS n FROM ev WHERE event_timestamp >= TIMESTAMP '{lo} 05:00:00' "
    "AND event_timestamp <= TIMESTAMP '2024-01-25 13:30:00'" for label, lo in
    [("10 DD", "2024-01-16"), ("2 WK", "2024-01-15"), ("1 MM", "2024-01-01"), ("1 YY", "2024-01-01")])))
add("scope_events", lambda s, d: b.events(s, d).where(eb.open_path_events(["_first_open"])).select("event_id", "event_name"),
    with_base("""SELECT event_id, event_name FROM ev WHERE event_name NOT IN ('_session_start','_session_stop',
 '_screen_view','_app_exception','_app_update','_os_update','_user_engagement','_profile_set','_page_view','_app_start',
 '_scroll','_search','_click','_clickstream_error','_mp_share','_mp_favorite','_app_end')"""))
add("date_units", lambda s, d: date_units(b.events(s, d), "America/New_York").select(
    "event_id", "month", "week", "day", "hour"), with_base(f"SELECT event_id, {units('America/New_York')} FROM ev"))

# ------------------------------------------------------------- event analyses

NAMES = ["_first_open", "purchase"]
_BASE_Q = Query(SCOPE, TZ, Conditions((_c(K, ">", 5), _c(PLATFORM, "<>", "iOS"))))
add("explore_base", lambda s, d: eb.base_data(b.user_events(s, d), _BASE_Q, eb.chosen_events(NAMES)).select(
    "event_id", "event_name", "event_timestamp", "user_pseudo_id", "user_id", "month", "week", "day", "hour"),
    with_base(f"""SELECT event_id, event_name, {clock('event_timestamp')} AS event_timestamp, user_pseudo_id, user_id,
  month, week, day, hour FROM picked""", picked(NAMES, "2024-01-03", "2024-01-20", TZ, "k > 5 AND platform <> 'iOS'")))

_EV = EventQuery(SCOPE, TZ, steps=(Step("_first_open", Conditions((_c(K, ">", 50),))), Step("purchase", method=EVENT_CNT)),
                 grouping=Grouping((PLATFORM, KIND)))
add("event_analysis", lambda s, d: eb.event_analysis(b.user_events(s, d), _EV), with_base(f"""
SELECT day AS event_date, '1__first_open' AS event_name, platform, kind AS e_kind, count(DISTINCT user_pseudo_id) AS count
FROM picked WHERE event_name = '_first_open' AND k > 50 GROUP BY ALL
UNION ALL SELECT day, '2_purchase', platform, kind, count(DISTINCT event_id) FROM picked WHERE event_name = 'purchase' GROUP BY ALL""",
    picked(NAMES, "2024-01-03", "2024-01-20", TZ)))
add("event_rows", lambda s, d: eb.event_rows(b.user_events(s, d), _EV), with_base("""
SELECT DISTINCT day AS event_date, '1__first_open' AS event_name, platform, kind AS e_kind, user_pseudo_id AS x_id
FROM picked WHERE event_name = '_first_open' AND k > 50
UNION ALL SELECT DISTINCT day, '2_purchase', platform, kind, event_id FROM picked WHERE event_name = 'purchase'""",
    picked(NAMES, "2024-01-03", "2024-01-20", TZ)))

_VALUE = Attribute("event_value", data_type="double")
_EP = EventQuery(SCOPE, unit="week", grouping=Grouping((PLATFORM,)), steps=(
    Step("purchase", method=AGGREGATION_PROPERTY, attribute=_VALUE, aggregation="SUM"),
    Step("purchase", method=AGGREGATION_PROPERTY, attribute=_VALUE, aggregation="MEDIAN"),
    Step("purchase", method=AGGREGATION_PROPERTY, attribute=K, aggregation="AVG"),
    Step("purchase", method=AGGREGATION_PROPERTY, attribute=K, aggregation="MIN"),
    Step("purchase", method=AGGREGATION_PROPERTY, attribute=K, aggregation="MAX"),
    Step("_first_open", method=COUNT_PROPERTY, attribute=K),
    Step("_first_open"), Step("_first_open", method=EVENT_CNT)))
add("event_property", lambda s, d: eb.event_property(b.user_events(s, d), _EP), with_base(" UNION ALL ".join(
    f"SELECT week AS event_date, '{i}_{name}' AS event_name, platform, round(CAST({agg} AS DOUBLE), 8) AS amount FROM picked "
    f"WHERE event_name = '{name}' GROUP BY ALL" for i, name, agg in [
        (1, "purchase", "sum(event_value)"), (2, "purchase", "median(event_value)"), (3, "purchase", "avg(k)"),
        (4, "purchase", "min(k)"), (5, "purchase", "max(k)"), (6, "_first_open", "count(DISTINCT k)"),
        (7, "_first_open", "count(DISTINCT user_pseudo_id)"), (8, "_first_open", "count(DISTINCT event_id)")]),
    picked(NAMES, "2024-01-03", "2024-01-20")))

add("event_details", lambda s, d: eb.event_details(b.events(s, d), Query(SCOPE, TZ)).select(
    "event_id", "event_name", "event_time_local", "event_date"), with_base(f"""
SELECT event_id, event_name, {clock(local(TZ))} AS event_time_local, {day(local(TZ))} AS event_date FROM ev
WHERE {bounds('2024-01-03', '2024-01-20', TZ)}"""))

# -------------------------------------------------------------------- funnel

_VIEWED = "_screen_view"
STEPS = (Step("_first_open"), Step(_VIEWED, Conditions((_c(K, ">", 20),))), Step("purchase"))
_NAMES = ["_first_open", _VIEWED, "purchase"]
_F = FunnelQuery(SCOPE, TZ, steps=STEPS, window_seconds=86_400)


def arrivals(window: int | None, tz: str, equal: str = "") -> str:
    """`reach`: every start with the earliest time at which it can have got to each step; `seen`: every event that
    a start gets to. An event is got to if it comes after the earliest arrival at the step before, in the start's
    window (or on its day), with the start's `equal` columns."""
    days = [f"CAST({local(tz, c)} AS DATE)" for c in ("h.event_timestamp", "r.t0")]
    inside = (f"epoch_us(h.event_timestamp) - epoch_us(r.t0) <= {window * 1_000_000}" if window else f"{days[0]} = {days[1]}")
    inside += "".join(f" AND h.{c} = r.{c}" for c in equal.split(",") if c)
    cases = " ".join(f"WHEN event_name = '{n}'{' AND k > 20' if i == 1 else ''} THEN {i}" for i, n in enumerate(_NAMES))
    later = f"h.user_pseudo_id = r.user_pseudo_id AND {inside}"
    out = [f"hits AS (SELECT *, CASE {cases} END AS step FROM picked),",
           "reach0 AS (SELECT *, event_timestamp AS t0 FROM hits WHERE step = 0),"]
    for i in range(1, len(_NAMES)):
        out.append(f"""reach{i} AS (SELECT r.*, f.t AS t{i} FROM reach{i - 1} r LEFT JOIN (
  SELECT r.event_id, min(h.event_timestamp) AS t FROM reach{i - 1} r JOIN hits h
  ON h.step = {i} AND h.event_timestamp > r.t{i - 1} AND {later} GROUP BY r.event_id) f ON f.event_id = r.event_id),""")
    own = "r.month, r.week, r.day, r.hour, r.platform, r.geo_city"
    out.append(f"seen AS (SELECT 0 AS at_step, {own}, r.event_id AS e, r.user_pseudo_id AS u FROM reach0 r" + "".join(
        f"\n  UNION ALL SELECT {i}, {own}, h.event_id, h.user_pseudo_id FROM reach{i} r JOIN hits h "
        f"ON h.step = {i} AND h.event_timestamp > r.t{i - 1} AND {later}" for i in range(1, len(_NAMES))) + "),")
    return "\n".join(out)


_FB = picked(_NAMES, "2024-01-03", "2024-01-20", TZ)
_RATE = "round({a} / CAST(nullif({b}, 0) AS DOUBLE), 4)"


def table(x: str, by: str) -> str:
    c = [f"count(DISTINCT CASE WHEN at_step = {i} THEN {x} END)" for i in range(3)]
    return f"""SELECT {by}, {c[0]} AS "1__first_open", {_RATE.format(a=c[2], b=c[0])} AS total_conversion_rate,
  {c[1]} AS "2_{_VIEWED}", {_RATE.format(a=c[1], b=c[0])} AS "2_{_VIEWED}_rate",
  {c[2]} AS "3_purchase", {_RATE.format(a=c[2], b=c[1])} AS "3_purchase_rate" FROM seen GROUP BY {by}"""


def chart(x: str, by: str = "") -> str:
    head = f"{by}, " if by else ""
    names = " ".join(f"WHEN {i} THEN '{i + 1}_{n}'" for i, n in enumerate(_NAMES))
    return f"SELECT {head}CASE at_step {names} END AS event_name, count(DISTINCT {x}) AS count FROM seen GROUP BY ALL"


def _stamp(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE {clock(c)} END"


add("funnel_join", lambda s, d: fu.funnel_starts(b.user_events(s, d), _F).select(
    "event_id", "user_pseudo_id", "depth", F.try_element_at("reached", F.lit(2)).alias("t1"),
    F.try_element_at("reached", F.lit(3)).alias("t2")), with_base(f"""
SELECT event_id, user_pseudo_id, CAST(1 + (t1 IS NOT NULL)::INT + (t2 IS NOT NULL)::INT AS BIGINT) AS depth,
  {_stamp('t1')} AS t1, {_stamp('t2')} AS t2 FROM reach2""", _FB, arrivals(86400, TZ)))
add("funnel_table", lambda s, d: fu.funnel_table(b.user_events(s, d), _F), with_base(
    table("u", "day"), _FB, arrivals(86400, TZ)))
add("funnel_table_events", lambda s, d: fu.funnel_table(b.user_events(s, d), dataclasses.replace(
    _F, method=EVENT_CNT, unit="week", window_seconds=7200 * 12)), with_base(table("e", "week"), _FB, arrivals(7200 * 12, TZ)))
add("funnel_table_same_day", lambda s, d: fu.funnel_table(b.user_events(s, d), dataclasses.replace(
    _F, window_seconds=None, unit="month")), with_base(table("u", "month"), _FB, arrivals(None, TZ)))
add("funnel_chart", lambda s, d: fu.funnel_chart(b.user_events(s, d), _F), with_base(
    chart("u"), _FB, arrivals(86400, TZ)))
add("funnel_chart_events", lambda s, d: fu.funnel_chart(b.user_events(s, d), dataclasses.replace(_F, method=EVENT_CNT)),
    with_base(chart("e"), _FB, arrivals(86400, TZ)))
add("funnel_chart_days", lambda s, d: fu.funnel_chart(b.user_events(s, d), dataclasses.replace(
    _F, method=EVENT_CNT, window_seconds=None), by_day=True), with_base(chart("e", "day AS event_date"), _FB, arrivals(None, TZ)))
add("funnel_grouped", lambda s, d: fu.funnel_table(b.user_events(s, d), dataclasses.replace(
    _F, grouping=Grouping((PLATFORM,), "ALL"))), with_base(table("u", "day, platform"), _FB, arrivals(86400, TZ, equal="platform")))
add("funnel_grouped_first", lambda s, d: fu.funnel_table(b.user_events(s, d), dataclasses.replace(
    _F, grouping=Grouping((CITY,), "FIRST"))), with_base(table("u", "day, geo_city"), _FB, arrivals(86400, TZ)))
add("funnel_grouped_first_events", lambda s, d: fu.funnel_chart(b.user_events(s, d), dataclasses.replace(
    _F, method=EVENT_CNT, grouping=Grouping((CITY,), "FIRST")), by_day=True), with_base(
    chart("e", "day AS event_date, geo_city"), _FB, arrivals(86400, TZ)))

_SEVEN = ("_first_open", "_screen_view", "_session_start", "_click", "_screen_view", "purchase", "_screen_view")
add("funnel_seven_steps", lambda s, d: fu.funnel_starts(b.user_events(s, d), FunnelQuery(
    SCOPE, TZ, steps=tuple(Step(n) for n in _SEVEN), window_seconds=10 * 86_400)).select("event_id", "depth"), with_base("""
SELECT event_id, CAST(1 + """ + " + ".join(f"(t{i} IS NOT NULL)::INT" for i in range(1, 7)) + """ AS BIGINT) AS depth FROM a6""",
    picked(sorted({*_SEVEN}), "2024-01-03", "2024-01-20", TZ), "a0 AS (SELECT event_id, user_pseudo_id, event_timestamp AS t0 FROM picked "
    "WHERE event_name = '_first_open')," + "".join(f"""
a{i} AS (SELECT a.*, m.t AS t{i} FROM a{i - 1} a LEFT JOIN (SELECT a.event_id, min(n.event_timestamp) AS t FROM a{i - 1} a JOIN picked n
  ON n.user_pseudo_id = a.user_pseudo_id AND n.event_name = '{name}' AND n.event_timestamp > a.t{i - 1}
  AND epoch_us(n.event_timestamp) - epoch_us(a.t0) <= 864000000000 GROUP BY a.event_id) m ON m.event_id = a.event_id),"""
    for i, name in enumerate(_SEVEN) if i)))

# --------------------------------------------------------------------- paths


def path_sql(rows: str, keys: str, anchor: str, x: str = "user_pseudo_id", name: str = "event_name", named: str = "picked",
             steps: int = 5) -> str:
    """Edges read off the list of each key's events, from its first anchor on."""
    return with_base(f"""SELECT walk[i].event_date AS event_date, walk[i].name || '_' || i AS source,
  CASE WHEN i < len(walk) THEN walk[i + 1].name ELSE 'lost' END || '_' || (i + 1) AS target, walk[i].{x} AS x_id
FROM (SELECT walk, unnest(range(1, least(len(walk), {steps - 1}) + 1)) AS i FROM walks)""", rows, f"""
lists AS (SELECT list({{'name': {name}, 'event_date': day, 'user_pseudo_id': user_pseudo_id, 'event_id': event_id}}
  ORDER BY event_timestamp, event_id, {name}) AS items, list({name} ORDER BY event_timestamp, event_id, {name}) AS names
  FROM {named} GROUP BY {keys}),
walks AS (SELECT items[list_position(names, '{anchor}'):] AS walk FROM lists WHERE list_contains(names, '{anchor}')),""")


def bursts(lag: int) -> str:
    """`grouped`: events with the number of pauses up to and including their own. An event starts a pause if no other
    event of the user follows within the lag."""
    return f"""pauses AS (SELECT user_pseudo_id, event_timestamp FROM picked a WHERE NOT EXISTS (SELECT 1 FROM picked z
  WHERE z.user_pseudo_id = a.user_pseudo_id AND z.event_timestamp > a.event_timestamp
  AND epoch_us(z.event_timestamp) - epoch_us(a.event_timestamp) < {lag * 1_000_000})),
grouped AS (SELECT a.*, coalesce(n, 0) AS burst FROM picked a LEFT JOIN (SELECT a.event_id, count(*) AS n FROM picked a JOIN pauses p
  ON p.user_pseudo_id = a.user_pseudo_id AND p.event_timestamp <= a.event_timestamp GROUP BY a.event_id) c ON c.event_id = a.event_id),"""


_PN = ["_first_open", "_session_start", "purchase", "_screen_view"]
_PSTEPS = tuple(Step(n) for n in _PN)
_PB = picked(_PN, "2024-01-03", "2024-01-20", TZ)
_PO = picked(None, "2024-01-03", "2024-01-20", TZ, "event_name NOT IN ('_session_start','_screen_view','_app_exception','_page_view','_click')")
_P = PathQuery(SCOPE, TZ, steps=_PSTEPS, max_step=6)
_SK = "user_pseudo_id, session_id"
add("path_session", lambda s, d: pa.event_path(b.user_events(s, d), _P), path_sql(_PB, _SK, "_first_open", steps=6))
add("path_session_events", lambda s, d: pa.path_counts(pa.event_path(b.user_events(s, d), dataclasses.replace(
    _P, method=EVENT_CNT, steps=(Step("_first_open"),), max_step=5))),
    "SELECT event_date, source, target, count(DISTINCT x_id) AS count FROM (" + path_sql(_PO, _SK, "_first_open", "event_id") + ") GROUP BY ALL")
_GAP = dataclasses.replace(_P, by="gap", lag_seconds=20 * 3600, max_step=5)
add("path_gap", lambda s, d: pa.event_path(b.user_events(s, d), _GAP),
    path_sql(_PB + bursts(72000), "user_pseudo_id, burst", "_first_open", named="grouped"))
add("path_other", lambda s, d: pa.event_path(b.user_events(s, d), dataclasses.replace(
    _P, steps=(Step("_first_open"), Step("purchase")), include_others=True, max_step=5)),
    path_sql(_PO, _SK, "_first_open", name="CASE WHEN event_name IN ('_first_open','purchase') THEN event_name ELSE 'other' END"))
add("path_merge", lambda s, d: pa.event_path(b.user_events(s, d), dataclasses.replace(_P, merge_repeats=True, max_step=5)),
    path_sql(_PB + """
latest AS (SELECT a.* FROM picked a JOIN (SELECT event_name, user_pseudo_id, session_id, max(event_timestamp) AS t FROM picked GROUP BY ALL) m
  ON a.event_name = m.event_name AND a.user_pseudo_id = m.user_pseudo_id AND a.session_id = m.session_id AND a.event_timestamp = m.t),""",
             _SK, "_first_open", named="latest"))
add("path_merge_runs", lambda s, d: pa.event_path(b.user_events(s, d), dataclasses.replace(
    _P, merge_repeats=True, max_step=5, compat=False)),
    path_sql(_PB + """
runs AS (SELECT * FROM picked QUALIFY coalesce(lead(event_name) OVER (PARTITION BY user_pseudo_id, session_id
  ORDER BY event_timestamp, event_id), '') <> event_name),""", _SK, "_first_open", named="runs"))
_SAME = (Step("_first_open", Conditions((_c(K, "<", 50),))), Step("_first_open", Conditions((_c(K, ">=", 30),))), Step("purchase"))
# One scan: each event with the labels of all the steps that it matches.
add("path_same_event", lambda s, d: pa.event_path(b.user_events(s, d), dataclasses.replace(_P, steps=_SAME, max_step=5)),
    path_sql(picked(["_first_open", "purchase"], "2024-01-03", "2024-01-20", TZ) + """
labelled AS (SELECT *, unnest([x FOR x IN [CASE WHEN event_name = '_first_open' AND k < 50 THEN '1__first_open' END,
  CASE WHEN event_name = '_first_open' AND k >= 30 THEN '2__first_open' END, CASE WHEN event_name = 'purchase' THEN '3_purchase' END]
  IF x IS NOT NULL]) AS label FROM picked),""", _SK, "1__first_open", name="label", named="labelled"))
_N = PathQuery(SCOPE, TZ, node_type="screen_view_screen_id", nodes=("sid1",), max_step=4)
_NB = picked(["_screen_view", "_page_view"], "2024-01-03", "2024-01-20", TZ)
add("node_path_session", lambda s, d: pa.node_path(b.user_events(s, d), _N),
    path_sql(_NB, _SK, "sid1", name="screen_view_screen_id", steps=4))
_N2 = dataclasses.replace(_N, nodes=("sid1", "sid2", "sid3"), include_others=True, by="gap", lag_seconds=36 * 3600, max_step=5)
add("node_path_gap", lambda s, d: pa.node_path(b.user_events(s, d), _N2), path_sql(
    _NB + bursts(36 * 3600), "user_pseudo_id, burst", "sid1", named="grouped",
    name="CASE WHEN screen_view_screen_id IN ('sid1','sid2','sid3') THEN screen_view_screen_id ELSE 'other' END"))

# ----------------------------------------------------------------- retention


def retention_sql(pairs, start: str, end: str, group: str = "", link: str = "", shown: str = "{}") -> str:
    """Who started on the first day is a list of people, who came back on a day another one; the rate is the size of
    what both have in common over the size of the first. With a link, the two are lists of (person, linked value)."""
    who = f"{{'person': user_pseudo_id, 'link': {link}}}" if link else "{'person': user_pseudo_id}"
    known = f"FILTER ({link} IS NOT NULL)" if link else ""
    own = f"{group}, " if group else ""
    alike = f" AND began.{group} IS NOT DISTINCT FROM came.{group}" if group else ""
    rates = [f"""SELECT * FROM (
  WITH began AS (SELECT {own}list(DISTINCT {who}) {known} AS people, count(DISTINCT user_pseudo_id) AS size
         FROM picked WHERE {opens} AND CAST(day AS DATE) = DATE '{start}' GROUP BY ALL),
       came AS (SELECT {own}CAST(day AS DATE) AS on_day, list(DISTINCT {who}) AS people FROM picked WHERE {returns} GROUP BY ALL)
  SELECT {f"began.{group}, " if group else ""}'{label}_{i}' AS grouping, {day(shown.format(f"DATE '{start}'"))} AS start_event_date,
    {day(shown.format("calendar.on_day"))} AS event_date,
    round(len(list_distinct([p.person FOR p IN list_intersect(coalesce(began.people, []), coalesce(came.people, []))])) / CAST(size AS DOUBLE), 4) AS retention
  FROM began CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY)) AS DATE) AS on_day) calendar
  LEFT JOIN came ON came.on_day = calendar.on_day{alike})""" for i, (label, opens, returns) in enumerate(pairs)]
    return "\nUNION ALL\n".join(rates)


_RP = RetentionPair(Step("_first_open"), Step("purchase"))
_RP2 = RetentionPair(Step("_session_start", Conditions((_c(K, ">", 10),))), Step("_screen_view"))
_RQ = RetentionQuery(Scope.days("2024-01-03", "2024-01-16"), TZ, pairs=(_RP, _RP2))
_RNAMES = ["_first_open", "purchase", "_session_start", "_screen_view"]
_RSQL = [("_first_open", "event_name = '_first_open'", "event_name = 'purchase'"),
         ("_session_start", "event_name = '_session_start' AND k > 10", "event_name = '_screen_view'")]
_RB = picked(_RNAMES, "2024-01-03", "2024-01-16", TZ)
add("explore_retention", lambda s, d: re_.retention(b.user_events(s, d), _RQ),
    with_base(retention_sql(_RSQL, "2024-01-03", "2024-01-16"), _RB))
_RL = dataclasses.replace(_RQ, pairs=(RetentionPair(_RP.start, _RP.back, CITY, CITY),), grouping=Grouping((PLATFORM,)))
add("retention_linked", lambda s, d: re_.retention(b.user_events(s, d), _RL),
    with_base(retention_sql(_RSQL[:1], "2024-01-03", "2024-01-16", "platform", "geo_city"), _RB))
add("retention_unit", lambda s, d: re_.retention(b.user_events(s, d), dataclasses.replace(_RQ, unit="week")),
    with_base(retention_sql(_RSQL, "2024-01-03", "2024-01-16", shown="(CAST(date_trunc('week', {}) AS DATE) - 1)"), _RB))

# --------------------------------------------------------------- attribution

_TARGET = Step("purchase", Conditions((_c(K, ">", 10),)))
_TOUCH = (Step("_first_open"), Step("_screen_view", Conditions((_c(K, "<", 70),))), Step("_session_start"))
_A = AttributionQuery(SCOPE, target=_TARGET, touches=_TOUCH, touch_names=("opened", "", "started"), window_seconds=5 * 86_400)
_AN = ["_first_open", "_screen_view", "_session_start", "purchase"]


def credited(window: str, start: str = "2024-01-03", end: str = "2024-01-20", back: int = 5) -> str:
    """`credit`: each touch inside the window of the conversion that follows it, with its place among that conversion's
    touches from either end. The conversion that follows is found by an as-of lookup."""
    lo = (dt.date.fromisoformat(start) - dt.timedelta(days=back)).isoformat()
    return picked(_AN, lo, end, user="user_pseudo_id") + f"""
sales AS (SELECT user_pseudo_id, event_id, session_id, event_timestamp, event_value FROM picked WHERE event_name = 'purchase' AND k > 10),
touched AS (SELECT user_pseudo_id, event_id, session_id, event_timestamp, CASE event_name WHEN '_first_open' THEN '1__first_open'
  WHEN '_screen_view' THEN '2__screen_view' ELSE '3__session_start' END AS label FROM picked
  WHERE event_name IN ('_first_open', '_session_start') OR event_name = '_screen_view' AND k < 70),
followed AS (SELECT touch.*, sale.event_id AS sale_id, sale.event_timestamp AS sold_at, sale.event_value AS worth
  FROM touched touch ASOF JOIN sales sale ON touch.user_pseudo_id = sale.user_pseudo_id AND touch.event_timestamp <= sale.event_timestamp
  WHERE {window} AND sale.event_timestamp >= TIMESTAMP '{start}'),
credit AS (SELECT *, count(*) OVER (PARTITION BY sale_id) AS among,
  row_number() OVER (PARTITION BY sale_id ORDER BY event_timestamp, event_id) AS place FROM followed),"""


_WIN = "epoch_us(sale.event_timestamp) - epoch_us(touch.event_timestamp) <= 432000000000"


def attribution_sql(share: str) -> str:
    """Totals per label; `share` is what a touch gets of its conversion, null for those that get nothing."""
    return f"""SELECT (SELECT count(*) FROM touched t WHERE t.label = c.label) AS trigger_count,
  CASE c.label WHEN '1__first_open' THEN 'opened' WHEN '3__session_start' THEN 'started' ELSE c.label END AS touch_point_name,
  (SELECT count(*) FROM sales) AS total_conversions, count(*) AS triggers_with_conversion,
  round(CAST(sum({share}) AS DOUBLE), 8) AS contribution,
  round(CAST(sum({share}) AS DOUBLE) / (SELECT sum({share}) FROM credit), 8) AS contribution_rate
FROM credit c GROUP BY c.label HAVING count({share}) > 0"""


_EVEN = "1 / CAST(among AS DOUBLE)"
_LATEST = "CASE WHEN place = among THEN {} END"
_POS = "CAST(CASE among WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 ELSE CASE WHEN place IN (1, among) THEN 0.4 ELSE CAST(0.2 AS DOUBLE) / among END END AS DOUBLE)"
_ACTE = credited(_WIN)
add("attribution_base", lambda s, d: at.attribution_base(b.events(s, d), _A).drop("conversion_session", "session_id"),
    with_base(f"""SELECT user_pseudo_id, sale_id AS conversion_id, {clock('sold_at')} AS conversion_time, event_id,
  {clock('event_timestamp')} AS event_timestamp, label, place AS row_seq FROM credit""", _ACTE))
add("attribution_last", lambda s, d: at.attribution(b.events(s, d), _A), with_base(attribution_sql(_LATEST.format("1.0")), _ACTE))
add("attribution_first", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(_A, model="FIRST")),
    with_base(attribution_sql("CASE WHEN place = 1 THEN 1.0 END"), _ACTE))
add("attribution_linear", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(_A, model="LINEAR")),
    with_base(attribution_sql(_EVEN), _ACTE))
add("attribution_position", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(_A, model="POSITION")),
    with_base(attribution_sql(_POS), _ACTE))
add("attribution_value", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(
    _A, model="LINEAR", method=SUM_VALUE, value=_VALUE)), with_base(attribution_sql("worth / CAST(among AS DOUBLE)"), _ACTE))
add("attribution_value_last", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(
    _A, method=SUM_VALUE, value=_VALUE)), with_base(attribution_sql(_LATEST.format("worth")), _ACTE))
add("attribution_window", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(
    _A, window="SESSION", window_seconds=None, model="LINEAR")),
    with_base(attribution_sql(_EVEN), credited("sale.session_id = touch.session_id", back=0)))
add("attribution_window_day", lambda s, d: at.attribution(b.events(s, d), dataclasses.replace(
    _A, window="CURRENT_DAY", window_seconds=None, model="LINEAR")), with_base(
    attribution_sql(_EVEN), credited("CAST(sale.event_timestamp AS DATE) = CAST(touch.event_timestamp AS DATE)", back=0)))
add("attribution_scope", lambda s, d: at.touches(b.events(s, d), dataclasses.replace(
    _A, scope=Scope.days("2024-01-10", "2024-01-12"))).select("conversion_id", "event_id", "label"), with_base(
    "SELECT sale_id AS conversion_id, event_id, label FROM credit", credited(_WIN, "2024-01-10", "2024-01-12")))
