"""Typed descriptions of the ad-hoc questions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Property categories and value types. Fixed values.
EVENT, USER, EVENT_OUTER, USER_OUTER = "EVENT", "USER", "EVENT_OUTER", "USER_OUTER"
STRING, INTEGER, DOUBLE, FLOAT, NUMBER, BOOLEAN = "string", "int", "double", "float", "number", "boolean"

# Compute methods. Fixed values.
USER_ID_CNT, EVENT_CNT, COUNT_PROPERTY, AGGREGATION_PROPERTY, SUM_VALUE = (
    "USER_ID_CNT", "EVENT_CNT", "COUNT_PROPERTY", "AGGREGATION_PROPERTY", "SUM_VALUE")


@dataclass(frozen=True)
class Attribute:
    """A property: a key of the event or user map, or a flat column."""

    name: str
    category: str = EVENT_OUTER
    data_type: str = STRING

    @property
    def column_name(self) -> str:
        return {EVENT: "e_", USER: "u_"}.get(self.category, "") + self.name


@dataclass(frozen=True)
class Condition:
    attribute: Attribute
    operator: str
    values: tuple = ()


@dataclass(frozen=True)
class Conditions:
    items: tuple[Condition, ...] = ()
    operator: str = "and"


@dataclass(frozen=True)
class Scope:
    """A fixed range of local days, or the last N units up to `now`."""

    kind: str = "FIXED"
    start: dt.date | None = None
    end: dt.date | None = None
    last_n: int = 1
    unit: str = "DD"
    now: dt.datetime | None = None
    look_back_seconds: int = 0

    @staticmethod
    def days(start: str, end: str) -> "Scope":
        return Scope("FIXED", dt.date.fromisoformat(start), dt.date.fromisoformat(end))

    @staticmethod
    def last(n: int, unit: str, now: dt.datetime) -> "Scope":
        return Scope("RELATIVE", last_n=n, unit=unit, now=now)


@dataclass(frozen=True)
class Step:
    """An event with an optional condition, and how to measure it."""

    event_name: str
    conditions: Conditions | None = None
    method: str = USER_ID_CNT
    attribute: Attribute | None = None
    aggregation: str | None = None


@dataclass(frozen=True)
class Grouping:
    attributes: tuple[Attribute, ...]
    apply_to: str = "ALL"

    @property
    def names(self) -> list[str]:
        return [a.column_name for a in self.attributes]


@dataclass(frozen=True)
class Query:
    scope: Scope
    tz: str = "UTC"
    conditions: Conditions | None = None
    grouping: Grouping | None = None
    unit: str = "day"


@dataclass(frozen=True)
class FunnelQuery(Query):
    steps: tuple[Step, ...] = ()
    method: str = USER_ID_CNT
    window_seconds: int | None = None  # None: every step on the local day of the one before
    join_column: str | None = None


@dataclass(frozen=True)
class EventQuery(Query):
    steps: tuple[Step, ...] = ()


@dataclass(frozen=True)
class PathQuery(Query):
    steps: tuple[Step, ...] = ()
    nodes: tuple[str, ...] = ()
    node_type: str | None = None
    by: str = "session"  # or "gap"
    lag_seconds: int = 3600
    max_step: int = 5
    method: str = USER_ID_CNT
    include_others: bool = False
    merge_repeats: bool = False
    compat: bool = True


@dataclass(frozen=True)
class RetentionPair:
    start: Step
    back: Step
    start_link: Attribute | None = None
    back_link: Attribute | None = None


@dataclass(frozen=True)
class RetentionQuery(Query):
    pairs: tuple[RetentionPair, ...] = ()


@dataclass(frozen=True)
class AttributionQuery(Query):
    target: Step | None = None
    touches: tuple[Step, ...] = ()
    touch_names: tuple[str, ...] = ()
    model: str = "LAST"
    weights: tuple[float, float, float] = (0.4, 0.2, 0.4)
    window: str = "CUSTOMIZE"  # or SESSION, CURRENT_DAY
    window_seconds: int | None = None
    method: str = EVENT_CNT
    value: Attribute | None = None
    compat: bool = False
