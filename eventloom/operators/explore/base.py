"""The rows an analysis reads: scope, event names, global condition, date units."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.conditions import compile_conditions, property_column
from eventloom.functions.timeunits import date_units, in_scope, local
from eventloom.names import BUILTIN_EVENTS, VIEW_EVENTS
from eventloom.operators.median import exact_medians
from eventloom.operators.explore.model import EventQuery, Grouping, Query, Step


def step_condition(step: Step) -> Column:
    return (F.col("event_name") == step.event_name) & compile_conditions(step.conditions)


def names_of(steps: tuple[Step, ...]) -> list[str]:
    return list(dict.fromkeys(s.event_name for s in steps))


def chosen_events(names: list[str]) -> Column:
    return F.col("event_name").isin(names)


def open_path_events(names: list[str]) -> Column:
    """Everything except the other built-in events."""
    return ~F.col("event_name").isin([e for e in BUILTIN_EVENTS if e not in names])


def view_events() -> Column:
    return F.col("event_name").isin(VIEW_EVENTS)


def group_columns(grouping: Grouping | None) -> list[Column]:
    return [property_column(a).cast("string").alias(a.column_name) for a in grouping.attributes] if grouping else []


def base_data(view: DataFrame, q: Query, events: Column | None = None, merged: bool = True) -> DataFrame:
    """Filtered events with date units. `user_pseudo_id` is the merged user unless told otherwise."""
    keep = in_scope(q.scope, q.tz) & compile_conditions(q.conditions)
    if events is not None:
        keep = keep & events
    rows = view.where(keep)
    if merged:
        rows = rows.withColumn("user_pseudo_id", F.col("merged_user_id"))
    return date_units(rows, q.tz)


def event_details(view: DataFrame, q: Query) -> DataFrame:
    """Rows of the scope with local time and date, for detail dashboards."""
    at = local("event_timestamp", q.tz)
    return view.where(in_scope(q.scope, q.tz)).withColumn(
        "event_time_local", at).withColumn("event_date", F.to_date(at))


# ------------------------------------------------------------- event analysis

def _branches(base: DataFrame, q: EventQuery) -> DataFrame:
    """One row per (event, matching step) in a single pass over the events."""
    hits = [F.when(step_condition(s), F.struct(
        F.lit(i).alias("i"), F.lit(f"{i + 1}_{s.event_name}").alias("label"))) for i, s in enumerate(q.steps)]
    return base.withColumn("_hit", F.explode(F.array_compact(F.array(*hits))))


def event_rows(view: DataFrame, q: EventQuery) -> DataFrame:
    """Distinct (day, event label, groups, user or event id)."""
    rows = _branches(base_data(view, q, chosen_events(names_of(q.steps))), q)
    by_event = [i for i, s in enumerate(q.steps) if s.method == "EVENT_CNT"]
    x = F.when(F.col("_hit.i").isin(by_event), F.col("event_id")).otherwise(F.col("user_pseudo_id"))
    return rows.select(
        F.to_date("day").alias("event_date"), F.col("_hit.label").alias("event_name"),
        *group_columns(q.grouping), x.alias("x_id"),
    ).where(F.col("x_id").isNotNull()).distinct()


def event_analysis(view: DataFrame, q: EventQuery) -> DataFrame:
    names = q.grouping.names if q.grouping else []
    return event_rows(view, q).groupBy("event_date", "event_name", *names).agg(F.count("x_id").alias("count"))


AGGREGATES = {"min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg}


def event_property(view: DataFrame, q: EventQuery) -> DataFrame:
    """Per step: distinct ids or property values, or an aggregate of a property.

    The property of every step lands in one numeric or text column per method, so
    all steps are measured in one aggregation over one scan. Distinct counting
    is planned only when a step asks for it; medians are selected by counted ranks.
    """
    rows = _branches(base_data(view, q, chosen_events(names_of(q.steps))), q)
    groups = group_columns(q.grouping)
    unit = F.col(q.unit).alias("event_date")
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, s in enumerate(q.steps):
        here = F.col("_hit.i") == i
        if s.method == "AGGREGATION_PROPERTY":
            number = F.when(here, property_column(s.attribute).cast("double")).otherwise(number)
        else:
            value = {"EVENT_CNT": F.col("event_id"), "USER_ID_CNT": F.col("user_pseudo_id")}.get(s.method)
            value = property_column(s.attribute).cast("string") if value is None else value
            text = F.when(here, value).otherwise(text)
    rows = rows.select(unit, F.col("_hit.label").alias("event_name"), *groups,
                       text.alias("_text"), number.alias("_number"))
    wanted: dict[str, list[str]] = {}
    for i, s in enumerate(q.steps):
        kind = s.aggregation.lower() if s.method == "AGGREGATION_PROPERTY" else "distinct"
        wanted.setdefault(kind, []).append(f"{i + 1}_{s.event_name}")
    # One aggregate per method that occurs; the label decides which one a row shows.
    keys = ["event_date", "event_name", *(q.grouping.names if q.grouping else [])]
    middle = wanted.pop("median", [])
    aggs, shown = [], F.lit(None).cast("double")
    for kind, labels in wanted.items():
        mine = F.col("event_name").isin(labels)
        agg = (F.countDistinct(F.when(mine, F.col("_text"))) if kind == "distinct"
               else AGGREGATES[kind](F.when(mine, F.col("_number"))))
        aggs.append(agg.cast("double").alias(f"_{kind}"))
        shown = F.when(mine, F.col(f"_{kind}")).otherwise(shown)
    is_middle = F.col("event_name").isin(middle)
    parts = [rows.where(~is_middle).groupBy(*keys).agg(*aggs).select(*keys, shown.alias("amount"))] if aggs else []
    if middle:
        parts.append(exact_medians(rows.where(is_middle), keys, "_number", "amount"))
    return functools.reduce(DataFrame.unionByName, parts)
