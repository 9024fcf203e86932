"""All metric tables in one run."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from eventloom.operators.metrics import (
    acquisition, activity, behaviour, engagement, lifecycle, pages, retention,
)
from eventloom.operators.upsert import expire_today

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Metric:
    build: Callable[[DataFrame, DataFrame], DataFrame]
    keys: tuple[str, ...]
    partition: str


# Table -> how it is built, its key and its partition column.
METRICS: dict[str, Metric] = {
    "event_daily_summary": Metric(lambda e, u: activity.event_daily(e),
                                  ("app_id", "event_date", "event_name", "platform", "geo_country"), "event_date"),
    "event_hourly_summary": Metric(lambda e, u: activity.event_hourly(e),
                                   ("app_id", "event_hour", "event_name", "platform", "geo_country"), "event_hour"),
    "user_behavior": Metric(lambda e, u: behaviour.user_behavior(e), ("app_id", "user_id", "user_pseudo_id"), "app_id"),
    "session_analysis": Metric(lambda e, u: engagement.session_analysis(e),
                               ("app_id", "session_id", "user_pseudo_id", "platform", "event_date"), "event_date"),
    "engagement_kpi": Metric(lambda e, u: engagement.engagement_kpi(e), ("app_id", "event_date", "platform"), "event_date"),
    "retention_daily": Metric(retention.retention_daily, ("app_id", "platform", "cohort_date", "day_number"), "cohort_date"),
    "retention_weekly": Metric(retention.retention_weekly, ("app_id", "platform", "cohort_date", "week_number"), "cohort_date"),
    "dau": Metric(lambda e, u: activity.dau(e), ("app_id", "event_date", "platform"), "event_date"),
    "wau": Metric(lambda e, u: activity.wau(e), ("app_id", "week_start", "platform"), "week_start"),
    "mau": Metric(lambda e, u: activity.mau(e), ("app_id", "month_start", "platform"), "month_start"),
    "new_return_user": Metric(activity.new_return, ("app_id", "event_date", "platform", "user_type"), "event_date"),
    "device": Metric(lambda e, u: behaviour.device_usage(e),
                     ("app_id", "event_date", "user_id", "platform", *behaviour.DEVICE_COLUMNS), "event_date"),
    "geo_user": Metric(lambda e, u: behaviour.geo_new_user(e),
                       ("app_id", "event_date", "platform", "geo_country", "geo_city"), "event_date"),
    "crash_rate": Metric(lambda e, u: behaviour.crash_rows(e),
                         ("app_id", "event_date", "platform", "app_version", "user_id", "crashed_user_id"), "event_date"),
    "page_screen_view": Metric(lambda e, u: pages.page_view(e), tuple(pages.KEYS), "event_date"),
    "entrance": Metric(lambda e, u: pages.entrance(e), tuple(pages.KEYS), "event_date"),
    "exit": Metric(lambda e, u: pages.exit_page(e), tuple(pages.KEYS), "event_date"),
    "event_name": Metric(lambda e, u: behaviour.event_name(e),
                         ("app_id", "event_date", "platform", "user_id", "event_name"), "event_date"),
    "user_acquisition": Metric(acquisition.acquisition, (
        "app_id", "event_date", "aggregation_type", "aggregation_dim", "platform", "user_pseudo_id"), "event_date"),
    "lifecycle_weekly": Metric(lambda e, u: lifecycle.lifecycle_weekly(e),
                               ("app_id", "time_period_week", "platform"), "time_period_week"),
}


def run_all(events: DataFrame, users: DataFrame, sink: Callable[[str, DataFrame, Metric], None],
            metrics: dict[str, Metric] | None = None) -> dict[str, str]:
    """Builds every metric and hands it to `sink`; a failure is noted and the others go on.

    The inputs are read for each metric, which needs few of their columns: pass stored
    tables rather than long plans.
    """
    failures: dict[str, str] = {}
    for name, metric in (metrics or METRICS).items():
        try:
            sink(name, metric.build(events, users), metric)
        except Exception as e:  # noqa: BLE001 - one bad metric must not stop the rest
            log.error("metric %s failed: %s", name, str(e).splitlines()[0])
            failures[name] = str(e)
    return failures


def expire_all(stored: dict[str, DataFrame], days: int, today: dt.date) -> dict[str, DataFrame]:
    """Metric tables without days older than `days` before today; the registry names each date column.

    Tables partitioned by something else than a date (user totals) do not expire.
    """
    return {name: expire_today(df, METRICS[name].partition, days, today)
            for name, df in stored.items() if METRICS[name].partition != "app_id"}
