"""Funnels without joining events to events.

A chain starts at one step-0 event, each later step comes strictly after the one
before, and all steps lie within N seconds of the start (or on its local day).
Two questions answer everything:

- backwards: the earliest chain of every start. Taking the earliest next step
  again and again reaches each step as early as any chain can, so it decides how
  far the start gets (user counts, any grouping of the start);
- forwards: the latest start that reaches an event. If any start within the
  window reaches it, the latest one does (event counts).

Each step looks up one neighbour by time (operators.ordered), which is linear in
the events and splits a very active user by the hour, whatever the window is.
"""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.timeunits import local
from eventloom.operators.explore.base import base_data, chosen_events, group_columns, names_of, step_condition
from eventloom.operators.explore.model import EVENT_CNT, FunnelQuery
from eventloom.operators.ordered import Borders, crowded, first_after, greatest_before
from eventloom.session import staged

# Unit of a date label -> (truncation, format). Fixed values.
LABELS = {"month": ("month", "yyyy-MM"), "week": ("week", "yyyy-MM-dd"),
          "day": ("day", "yyyy-MM-dd"), "hour": ("hour", "yyyy-MM-dd HH:00")}
SECOND = 1_000_000


def _first_only(q: FunnelQuery) -> bool:
    return q.grouping is not None and q.grouping.apply_to == "FIRST"


def _groups(q: FunnelQuery) -> list[str]:
    return q.grouping.names if q.grouping else []


def _keys(q: FunnelQuery) -> list[str]:
    """What the steps of one chain share: the user, groups on all steps, the day where that is the rule."""
    shared = [] if _first_only(q) else _groups(q)
    return ["_key", *shared, *(["_day"] if q.window_seconds is None else [])]


def _events(view: DataFrame, q: FunnelQuery) -> DataFrame:
    """Events of the funnel with their clock `_t` and one flag per step."""
    base = base_data(view, q, chosen_events(names_of(q.steps)))
    return base.select(
        F.col(q.join_column or "user_pseudo_id").alias("_key"), "event_id", "user_pseudo_id", "event_timestamp",
        "month", "week", "day", "hour", *group_columns(q.grouping), F.col("day").alias("_day"),
        F.unix_micros("event_timestamp").alias("_t"),
        *[step_condition(s).alias(f"_s{i}") for i, s in enumerate(q.steps)],
    )


def _joinable(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Later steps join by equality, so those without a key value cannot be reached."""
    return rows.dropna(subset=keys)


def funnel_starts(view: DataFrame, q: FunnelQuery) -> DataFrame:
    """One row per step-0 event: when its earliest chain reached each step, and how many steps that is."""
    # Each step reads the step before it several times; staged, the work grows with the steps and not with their product.
    rows, keys, n = staged(_events(view, q), "funnel"), _keys(q), len(q.steps)
    borders = crowded(rows, ["_key"], "_t")
    labels = ["event_id", "user_pseudo_id", "month", "week", "day", "hour",
              *[g for g in _groups(q) if g not in keys]]
    empty = F.array().cast("array<bigint>")
    chains = _joinable(rows.where(F.col(f"_s{n - 1}")), keys).select(*keys, "_t", F.array("_t").alias("_chain"))
    if n == 1:
        chains = rows.where("_s0").select(*keys, "_t", F.array("_t").alias("_chain"), F.struct(*labels).alias("_row"))
    for i in range(n - 2, -1, -1):
        here = rows.where(F.col(f"_s{i}"))
        here = here if i == 0 else _joinable(here, keys)
        # Only starts carry their labels along.
        row = F.struct(*labels).alias("_row") if i == 0 else F.lit(True).alias("_row")
        both = here.select(*keys, "_t", row).unionByName(chains.select(*keys, "_t", "_chain"), allowMissingColumns=True)
        ahead = first_after(both, keys, "_t", F.col("_chain"), "_next", borders=borders).where(F.col("_row").isNotNull())
        chains = ahead.select(*keys, "_t", "_row", F.concat(F.array("_t"), F.coalesce("_next", empty)).alias("_chain"))
        if i > 0:
            chains = staged(chains.drop("_row"), "chains")
    if q.window_seconds is not None:
        chains = chains.withColumn(
            "_chain", F.filter("_chain", lambda t: t - F.col("_t") <= q.window_seconds * SECOND))
    return chains.select(
        "_row.*", *[k for k in keys if k in _groups(q)],
        F.transform("_chain", lambda t: F.timestamp_micros(t)).alias("reached"), F.size("_chain").alias("depth"))


def _label(q: FunnelQuery, unit: str, at: Column | None = None) -> Column:
    cut, pattern = LABELS[unit]
    return F.date_format(F.date_trunc(cut, local("event_timestamp" if at is None else at, q.tz)), pattern)


def _reached(view: DataFrame, q: FunnelQuery) -> tuple[DataFrame, list[DataFrame], Borders | None]:
    """The starts, and for each later step its events that some chain reaches, with the latest start `_start` that does.

    Groups of the start are taken from the starts the user has: an event is looked at once for each of them.
    """
    rows, keys, n = staged(_events(view, q), "funnel"), _keys(q), len(q.steps)
    borders = crowded(rows, ["_key"], "_t")
    own = _groups(q) if _first_only(q) else []
    carried = [*dict.fromkeys([*keys, *_groups(q)]), "_t", "event_id", "user_pseudo_id"]
    starts = rows.where("_s0")
    reached, parts = starts.select(*carried, F.col("_t").alias("_start")), []
    cohorts = starts.select(*keys, *own).distinct()
    for i in range(1, n):
        here = _joinable(rows.where(F.col(f"_s{i}")), keys).drop(*own)
        if own:
            here = here.join(cohorts, keys)
        both = here.select(*carried).withColumn("_here", F.lit(True)).unionByName(
            reached.select(*keys, *own, "_t", "_start"), allowMissingColumns=True)
        prior = greatest_before(both, [*keys, *own], "_t", F.col("_start"), "_from", borders=borders).where(F.col("_here"))
        ok = F.col("_from").isNotNull()
        if q.window_seconds is not None:
            ok = ok & (F.col("_t") - F.col("_from") <= q.window_seconds * SECOND)
        reached = staged(prior.where(ok).select(*carried, F.col("_from").alias("_start")), "reached")
        parts.append(reached)
    return starts, parts, borders


def _events_by_label(view: DataFrame, q: FunnelQuery, unit: str) -> DataFrame:
    """Wide counts c0..cn-1 of events per label of the start and groups.

    Starts reach a step in the order of their time, so those that reach an event are all from the first one in its
    window to the latest that does: one run of the labels that the key has starts under. An event is added at the run's
    first label and taken off after its last, and summed along the labels; it is never copied to the labels between.
    """
    starts, parts, borders = _reached(view, q)
    keys = [*_keys(q), *(_groups(q) if _first_only(q) else [])]
    back = q.window_seconds * SECOND if q.window_seconds is not None else 2 * 86_400 * SECOND  # the keys hold the day
    label = lambda micros: _label(q, unit, F.timestamp_micros(micros))
    marks = [starts.groupBy(*keys, label("_t").alias("label")).agg(F.countDistinct("event_id").alias("c0"))]
    for i, reached in enumerate(parts, 1):
        both = starts.select(*keys, F.col("_t").alias("_at"), F.col("_t").alias("_first")).unionByName(
            reached.select(*keys, (F.col("_t") - back - 1).alias("_at"), "event_id", "_start"), allowMissingColumns=True)
        runs = first_after(both, keys, "_at", F.col("_first"), "_from", borders=borders).where(F.col("_start").isNotNull())
        counted = staged(runs.groupBy(*keys, label("_from").alias("_low"), label("_start").alias("_high")).agg(
            F.countDistinct("event_id").alias("_n")), "runs")
        ends = F.array(F.struct(F.col("_low").alias("label"), F.col("_n").alias(f"open{i}"), F.lit(0).cast("long").alias(f"shut{i}")),
                       F.struct(F.col("_high").alias("label"), F.lit(0).cast("long").alias(f"open{i}"), F.col("_n").alias(f"shut{i}")))
        marks.append(counted.select(*keys, F.explode(ends).alias("e")).select(*keys, "e.*"))
    steps = range(1, len(parts) + 1)
    sums = ["c0", *[f"{kind}{i}" for i in steps for kind in ("open", "shut")]]
    all_ = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), marks)
    cells = all_.groupBy(*keys, "label").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    # One row per key and label with starts: as many as the time range has labels.
    upto = Window.partitionBy(*keys).orderBy("label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = [(F.sum(f"open{i}").over(upto) - F.sum(f"shut{i}").over(upto) + F.col(f"shut{i}")).alias(f"c{i}") for i in steps]
    return cells.select(*keys, "label", "c0", *covered).groupBy("label", *_groups(q)).agg(
        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(parts) + 1)])


def _reaching_labels(q: FunnelQuery, unit: str) -> Column:
    """Labels of the starts that could still reach an event: those of its window."""
    cut, pattern = LABELS[unit]
    at = local("event_timestamp", q.tz)
    since = (F.date_trunc("day", at) if q.window_seconds is None
             else local(F.timestamp_micros(F.col("_t") - q.window_seconds * SECOND), q.tz))
    lo, hi = F.date_trunc(cut, F.least(since, at)), F.date_trunc(cut, F.greatest(since, at))
    return F.array_distinct(F.transform(
        F.sequence(lo, hi, F.expr(f"INTERVAL 1 {cut}")), lambda d: F.date_format(d, pattern)))


def _reached_events(view: DataFrame, q: FunnelQuery, unit: str | None) -> DataFrame:
    """(step, label and groups of the start, ids) of every event that some chain reaches.

    Counting the users of later events per label of the start (where chains are held together by
    something else than the user) needs an event once per label that reaches it, so later events
    are copied to the labels of their window; without labels nothing is copied. Groups of the start are taken from the starts the
    user has under the label.
    """
    rows, keys, n = staged(_events(view, q), "funnel"), _keys(q), len(q.steps)
    borders = crowded(rows, ["_key"], "_t")
    own = _groups(q) if _first_only(q) else []
    by = [*(["_label"] if unit else []), *own]
    starts = rows.where("_s0")
    starts = starts.withColumn("_label", _label(q, unit)) if unit else starts
    carried = [*dict.fromkeys([*keys, *_groups(q), *by]), "_t", "event_id", "user_pseudo_id"]
    reached = starts.select(*carried, F.col("_t").alias("_start"))
    parts = [reached.withColumn("step", F.lit(0))]
    cohorts = starts.select(*keys, *by).distinct()
    for i in range(1, n):
        here = _joinable(rows.where(F.col(f"_s{i}")), keys).drop(*own)
        if unit:
            here = here.withColumn("_label", F.explode(_reaching_labels(q, unit)))
        if own:
            here = here.join(cohorts, [*keys, *(["_label"] if unit else [])])
        part = [*dict.fromkeys([*keys, *by])]
        both = here.select(*carried).withColumn("_here", F.lit(True)).unionByName(
            reached.select(*part, "_t", "_start"), allowMissingColumns=True)
        prior = greatest_before(both, part, "_t", F.col("_start"), "_from", borders=borders).where(F.col("_here"))
        ok = F.col("_from").isNotNull()
        if q.window_seconds is not None:
            ok = ok & (F.col("_t") - F.col("_from") <= q.window_seconds * SECOND)
        reached = staged(prior.where(ok).select(*carried, F.col("_from").alias("_start")), "reached")
        parts.append(reached.withColumn("step", F.lit(i)))
    found = functools.reduce(DataFrame.unionByName, parts)
    return found.select("step", *([F.col("_label").alias("label")] if unit else []), *_groups(q),
                        "event_id", "user_pseudo_id")


def _counts(view: DataFrame, q: FunnelQuery, unit: str | None) -> DataFrame:
    """Wide counts c0..cn-1 per label and groups."""
    n = len(q.steps)
    groups = q.grouping.names if q.grouping else []
    by = (["label"] if unit else []) + groups
    if q.method != EVENT_CNT and q.join_column in (None, "user_pseudo_id"):
        starts = funnel_starts(view, q)
        if unit:
            starts = starts.withColumn("label", F.col(unit))
        # The deepest chain per user decides every step; users are counted once.
        users = starts.where(F.col("user_pseudo_id").isNotNull()).groupBy(*by, "user_pseudo_id").agg(
            F.max("depth").alias("depth"))
        return users.groupBy(*by).agg(*[F.count_if(F.col("depth") > i).alias(f"c{i}") for i in range(n)])
    if q.method == EVENT_CNT and unit:
        return _events_by_label(view, q, unit)
    x = "event_id" if q.method == EVENT_CNT else "user_pseudo_id"
    hits = _reached_events(view, q, unit).select(*by, "step", x).distinct()
    return hits.where(F.col(x).isNotNull()).groupBy(*by).agg(
        *[F.count_if(F.col("step") == i).alias(f"c{i}") for i in range(n)])


def _rate(top: str, bottom: str) -> Column:
    exact = F.col(top).cast("decimal(20,0)") / F.when(F.col(bottom) != 0, F.col(bottom)).cast("decimal(20,0)")
    return exact.cast("decimal(20,4)")


def funnel_table(view: DataFrame, q: FunnelQuery) -> DataFrame:
    """Counts per step with step rates and the total rate, by date unit and groups."""
    groups = q.grouping.names if q.grouping else []
    counts = _counts(view, q, q.unit)
    out = [F.col("label").alias(q.unit), *groups]
    for i, s in enumerate(q.steps):
        out.append(F.col(f"c{i}").alias(f"{i + 1}_{s.event_name}"))
        if i == 0:
            out.append(_rate(f"c{len(q.steps) - 1}", "c0").alias("total_conversion_rate"))
        else:
            out.append(_rate(f"c{i}", f"c{i - 1}").alias(f"{i + 1}_{s.event_name}_rate"))
    return counts.select(*out).orderBy(q.unit, F.desc(f"1_{q.steps[0].event_name}"))


def funnel_chart(view: DataFrame, q: FunnelQuery, by_day: bool = False) -> DataFrame:
    """(step event, count) rows, per day of the start when asked (and then per group)."""
    plain = q if by_day else dataclasses.replace(q, grouping=None)
    counts = _counts(view, plain, "day" if by_day else None)
    groups = plain.grouping.names if plain.grouping else []
    bars = F.array(*[F.struct(F.lit(f"{i + 1}_{s.event_name}").alias("event_name"), F.col(f"c{i}").alias("count"))
                     for i, s in enumerate(q.steps)])
    day = [F.to_date("label").alias("event_date")] if by_day else []
    return counts.select(*day, *groups, F.explode(bars).alias("b")).select(
        *(["event_date"] if by_day else []), *groups, "b.*").where("count > 0")
