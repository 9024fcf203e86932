"""Ad-hoc retention: who of the first day's starters did the return event on each day."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.conditions import property_column
from eventloom.functions.timeunits import scope_dates
from eventloom.operators.explore.base import base_data, chosen_events, group_columns, step_condition
from eventloom.operators.explore.model import RetentionPair, RetentionQuery
from eventloom.session import staged


def _shown(c: Column, unit: str) -> Column:
    """Weeks are shown by their Sunday, months by their first day."""
    if unit == "week":
        return F.date_sub(F.date_trunc("week", c).cast("date"), 1)
    return F.date_trunc("month", c).cast("date") if unit == "month" else c


def _linked(pair: RetentionPair) -> bool:
    return pair.start_link is not None and pair.back_link is not None


def retention(view: DataFrame, q: RetentionQuery) -> DataFrame:
    """Rate per start event and date of the range.

    Starters and returns are reduced to distinct (user, date) before they meet, so
    the join is one row per user and day on each side. The date list is a short
    literal sequence laid under the per-date counts; dates nobody returned on show 0.
    """
    names = list(dict.fromkeys(n for p in q.pairs for n in (p.start.event_name, p.back.event_name)))
    dates = scope_dates(q.scope, q.tz)
    first, last = F.lit(dates[0]), F.lit(dates[-1])
    base = base_data(view, q, chosen_events(names)).withColumn("event_date", F.to_date("day"))
    groups = q.grouping.names if q.grouping else []
    marks = []
    for i, pair in enumerate(q.pairs):
        marks += [step_condition(pair.start).alias(f"_s{i}"), step_condition(pair.back).alias(f"_b{i}")]
        if _linked(pair):
            marks += [property_column(pair.start_link).cast("string").alias(f"_ls{i}"),
                      property_column(pair.back_link).cast("string").alias(f"_lb{i}")]
    # Each pair reads its starters and returns; what they are chosen by is worked out once.
    rows = staged(base.select("user_pseudo_id", "event_date", *group_columns(q.grouping), *marks), "retention")
    parts = []
    for i, pair in enumerate(q.pairs):
        link = lambda side: [F.col(f"_l{side}{i}").alias("_link")] if _linked(pair) else []  # noqa: B023
        on = ["user_pseudo_id", *groups, *(["_link"] if _linked(pair) else [])]
        starts = rows.where(F.col(f"_s{i}") & (F.col("event_date") == first)).select("user_pseudo_id", *groups, *link("s")).distinct()
        backs = rows.where(F.col(f"_b{i}") & F.col("event_date").between(first, last)).select(
            "user_pseudo_id", *groups, *link("b"), "event_date").distinct()
        returned = starts.join(backs, on).groupBy(*groups, "event_date").agg(
            F.countDistinct("user_pseudo_id").alias("_back"))
        cohort = starts.groupBy(*groups).agg(F.countDistinct("user_pseudo_id").alias("_start"))
        cohort = cohort.where("_start > 0").withColumn(
            "event_date", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))
        same = [cohort[c].eqNullSafe(returned[c]) for c in [*groups, "event_date"]]
        joined = cohort.join(returned, functools.reduce(lambda a, c: a & c, same), "left")
        parts.append(joined.select(
            *[cohort[g].alias(g) for g in groups],
            F.lit(f"{pair.start.event_name}_{i}").alias("grouping"),
            first.cast("date").alias("start_event_date"), cohort["event_date"].alias("event_date"),
            F.coalesce("_back", F.lit(0)).alias("returned"), F.col("_start").alias("started"),
        ))
    rows = functools.reduce(DataFrame.unionByName, parts)
    rate = (F.col("returned").cast("decimal(20,0)") / F.col("started").cast("decimal(20,0)")).cast("decimal(20,4)")
    return rows.select(
        *groups, "grouping", _shown(F.col("start_event_date"), q.unit).alias("start_event_date"),
        _shown(F.col("event_date"), q.unit).alias("event_date"), rate.alias("retention"))
