"""From raw uploads to the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from eventloom.operators import clean, fields, sessions, tables, traffic
from eventloom.operators.agent import parse_ua
from eventloom.operators.geo import geo_ip
from eventloom.operators.parse import parse_events, time_shift
from eventloom.session import prepare, staged
from eventloom.sources import ods
from eventloom.sources.state import StateTable

Step = Callable[[DataFrame], DataFrame]


@dataclass
class Chain:
    """Named steps on the event table, then a last step, then the field rules."""

    steps: list[tuple[str, Step]] = field(default_factory=list)
    post: Step | None = None
    rules: dict[str, fields.FieldRule] = field(default_factory=dict)

    def run(self, events: DataFrame, app_ids: list[str]) -> DataFrame:
        for _, step in self.steps:
            events = events.transform(step)
        if self.post is not None:
            events = events.transform(self.post)
        return fields.apply_field_rules(events, self.rules, app_ids)


@dataclass
class EtlConfig:
    app_ids: list[str]
    out: str
    job: str
    now: dt.datetime
    category_rules: list[dict] = field(default_factory=list)
    channel_rules: list[dict] | None = None
    freshness_hours: int = 72
    shift_clocks: bool = False
    ranges: DataFrame | None = None
    chain: Chain = field(default_factory=Chain)
    keep_days: int = 180
    # Table (event, item, user) -> byte limits per column; rows that exceed them also go whole to `<out>/truncated/<table>`.
    limits: dict[str, dict[str, int]] = field(default_factory=dict)


def run(spark: SparkSession, uploads: DataFrame, config: EtlConfig) -> None:
    """One batch: rejects, events, items, sessions and users are written under `config.out`.

    Parsing is the costly part and feeds four tables, so its result is written
    once to the shared scratch folder; the tables read back only the columns they
    need, and a lost executor never repeats the parsing.
    """
    prepare(spark)
    now_msec = int(config.now.timestamp() * 1000)
    good, bad = clean.clean(uploads, config.app_ids, now_msec, config.freshness_hours)
    ods.write_rejects(bad, f"{config.out}/rejects", config.job)
    parsed = staged(parse_events(time_shift(good, now_msec, config.shift_clocks)), "parsed")
    # The referrer lookup reads its input twice, hence only after parsing is done.
    parsed = staged(traffic.traffic_source(parsed, config.category_rules, config.channel_rules), "sourced")

    events = clean.drop_bots(parse_ua(tables.extract_events(parsed, config.job, config.now)))
    if config.ranges is not None:
        events = geo_ip(events, config.ranges)
    def store(rows: DataFrame, table: str) -> None:
        kept, left = tables.limited(rows, config.limits.get(table))
        ods.write_ods(kept, f"{config.out}/{table}")
        if left is not None:
            ods.write_ods(left, f"{config.out}/truncated/{table}")

    # The address and the agent text served the enrichment and are not stored.
    store(config.chain.run(events, config.app_ids).drop("ua", "ip"), "event")
    store(tables.extract_items(parsed), "item")
    ods.write_ods(sessions.extract_sessions(
        tables.add_process_info(parsed, config.job, config.now)), f"{config.out}/session")

    partials = tables.partial_users(tables.user_rows(parsed))
    state = StateTable(spark, f"{config.out}/state/users", partials.schema, config.keep_days, "event_timestamp")
    history = state.read(config.now.date())
    users = tables.merge_user_state(partials, history)
    store(tables.add_process_info(users, config.job, config.now), "user")
    state.append(partials, config.now.date())
