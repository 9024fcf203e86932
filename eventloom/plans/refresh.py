"""Metric tables kept current: a run builds and replaces only what the events since the last run can have changed."""

from __future__ import annotations

import datetime as dt
import logging
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.metrics import behaviour
from eventloom.operators.upsert import MetricTable
from eventloom.plans.modelling import METRICS, Metric
from eventloom.session import finished, staged

log = logging.getLogger(__name__)

# What new events change of a table: the days they lie on (the default); the days of their sessions, whose duration or first
# view may have moved; the days of their users, whose first touch may have; cohorts of their users, counted over all days;
# or the totals of their users.
SESSION, USER, COHORT, TOTALS = "session", "user", "cohort", "totals"
REACH = {"session_analysis": SESSION, "engagement_kpi": SESSION, "entrance": SESSION, "exit": SESSION, "new_return_user": USER,
         "user_acquisition": USER, "retention_daily": COHORT, "retention_weekly": COHORT, "user_behavior": TOTALS}
# Partition columns that are the first day of a longer period.
PERIODS = {"week_start": "week", "time_period_week": "week", "month_start": "month"}
BUCKETS = 64
# Metrics built at a time: while one writes its last files or lists folders, the tasks of others use the cores.
AT_ONCE = 4


def _first_day(day: dt.date, period: str) -> dt.date:
    return day - dt.timedelta(days=day.weekday()) if period == "week" else day.replace(day=1)


class Changes:
    """What events created after `since` touch. The sets of days are as long as the calendar; keys stay on the cluster."""

    def __init__(self, events: DataFrame, users: DataFrame, since: dt.datetime):
        self.events, self.users = events.withColumn("_day", F.to_date("event_timestamp")), users
        self.new = staged(self.events.where(F.col("created_time") > F.lit(since)).select("app_id", "user_pseudo_id", "session_id", "_day"), "changes")
        self._known: dict[str, set[dt.date]] = {}
        self._lock = threading.Lock()

    def _of(self, *keys: str) -> DataFrame:
        return self.events.join(self.new.select(*keys).distinct(), list(keys), "left_semi")

    def days(self, reach: str) -> set[dt.date]:
        with self._lock:
            return self._days(reach)

    def _days(self, reach: str) -> set[dt.date]:
        if reach not in self._known:
            keys = {SESSION: ["session_id"], USER: ["user_pseudo_id"], COHORT: ["user_pseudo_id"]}.get(reach)
            days = {r["_day"] for r in (self._of(*keys) if keys else self.new).select("_day").distinct().collect()}
            if reach == COHORT:
                touched = F.to_date(F.timestamp_millis("first_touch_time_msec")).alias("_day")
                days |= {r["_day"] for r in self.users.join(self.new.select("user_pseudo_id").distinct(), "user_pseudo_id", "left_semi")
                         .select(touched).distinct().collect() if r["_day"]}
            self._known[reach] = days | {r["_day"] for r in self.new.select("_day").distinct().collect()}
        return self._known[reach]


def _bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("user_pseudo_id"), F.lit(BUCKETS)).cast("int"))


def _build(name: str, metric: Metric, events: DataFrame, users: DataFrame, changes: Changes | None) -> DataFrame:
    reach = REACH.get(name, "day")
    if reach == TOTALS:
        return _bucketed(metric.build(events, users) if changes is None else behaviour.user_behavior_of(events, changes.new))
    if changes is None:
        return metric.build(events, users)
    days = changes.days(reach)
    period = "week" if name == "retention_weekly" else PERIODS.get(metric.partition)
    starts = {_first_day(day, period) for day in days} if period else days
    if reach == COHORT:
        return metric.build(events, users).where(F.col(metric.partition).isin(sorted(starts)))
    if period:
        length = 7 if period == "week" else 31
        days = {start + dt.timedelta(days=k) for start in starts for k in range(length) if _first_day(start + dt.timedelta(days=k), period) == start}
    return metric.build(events.where(F.to_date("event_timestamp").isin(sorted(days))), users)


def metric_table(spark: SparkSession, root: str, name: str, metric: Metric, schema: T.StructType) -> MetricTable:
    if REACH.get(name) == TOTALS:
        return MetricTable(spark, f"{root}/{name}", schema, [*metric.keys, "bucket"], ["bucket"])
    return MetricTable(spark, f"{root}/{name}", schema, list(metric.keys), [metric.partition])


def last_run(spark: SparkSession, root: str, name: str) -> dt.datetime | None:
    """Up to which creation time a table holds the events."""
    done = finished(spark, f"{root}/_runs/{name}")
    return max((dt.datetime.strptime(x, "%Y%m%d%H%M%S%f") for x in done), default=None)


def refresh_all(spark: SparkSession, events: DataFrame, users: DataFrame, root: str, until: dt.datetime,
                metrics: dict[str, Metric] | None = None) -> dict[str, str]:
    """Brings every metric table under `root` up to the events created until then; returns the failures.

    `events` holds all stored events with `created_time`, `users` the users as they are now. Each table remembers its
    last run. Days, weeks, months and cohorts that new events reach are built anew and replace what was there, user totals are
    replaced by key. A change of a table happens once for its `until`, also if the run is repeated; a table
    that failed starts from its own last run next time.
    """
    metrics = metrics or METRICS
    seen = events.where(F.col("created_time") <= F.lit(until))
    stamp, changes, lock = until.strftime("%Y%m%d%H%M%S%f"), {}, threading.Lock()

    def since_then(since: dt.datetime | None) -> Changes | None:
        with lock:
            if since is not None and since not in changes:
                changes[since] = Changes(seen, users, since)
            return changes.get(since)

    def bring(name: str, metric: Metric) -> str | None:
        try:
            since = last_run(spark, root, name)
            if since is not None and since >= until:
                return None
            rows = _build(name, metric, seen, users, since_then(since))
            table = metric_table(spark, root, name, metric, rows.schema)
            if REACH.get(name) == TOTALS:
                table.upsert(rows, stamp)
            else:
                table.refresh_days(rows, stamp)
            spark.range(1).write.mode("overwrite").parquet(f"{root}/_runs/{name}/{stamp}")
        except Exception as e:  # noqa: BLE001 - one bad metric must not stop the rest
            log.error("metric %s failed: %s", name, str(e).splitlines()[0])
            return str(e)
        return None

    with ThreadPoolExecutor(AT_ONCE) as pool:
        told = [pool.submit(inheritable_thread_target(spark)(bring), *item) for item in metrics.items()]
    return {name: t.result() for name, t in zip(metrics, told, strict=True) if t.result() is not None}
