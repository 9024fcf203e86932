"""Event and node paths: what follows an anchor, step by step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.dedupe import keep_one
from eventloom.operators.explore.base import (
    base_data, chosen_events, names_of, open_path_events, step_condition, view_events,
)
from eventloom.operators.explore.model import EVENT_CNT, PathQuery
from eventloom.operators.ordered import crowded, next_value, running_sum
from eventloom.session import staged

ORDER = ["event_timestamp", "event_id", "name"]
OTHER = "other"


def _event_rows(view: DataFrame, q: PathQuery) -> tuple[DataFrame, str]:
    """Named rows of an event path and the name of its anchor."""
    names = names_of(q.steps)
    start_from = len(q.steps) == 1
    events = open_path_events(names) if (q.include_others or start_from) else chosen_events(names)
    rows = base_data(view, q, events)
    fold = lambda c: c if start_from else F.when(F.col("event_name").isin(names), c).otherwise(F.lit(OTHER))
    if len(names) < len(q.steps):
        # One event chosen under several conditions: each condition numbers its own copy.
        hits = [F.when(step_condition(s), F.struct(F.lit(f"{i + 1}_{s.event_name}").alias("name")))
                for i, s in enumerate(q.steps)]
        rows = rows.withColumn("_h", F.explode(F.array_compact(F.array(*hits)))).withColumn("name", F.col("_h.name"))
        return _select(_merged(rows, q, ["name"]), F.col("name")), f"1_{names[0]}"
    return _select(_merged(rows, q, ["event_name"]), fold(F.col("event_name"))), names[0]


def _node_rows(view: DataFrame, q: PathQuery) -> tuple[DataFrame, str]:
    start_from = len(q.nodes) == 1
    rows = base_data(view, q, view_events()).withColumn("_node", F.col(q.node_type))
    rows = _merged(rows, q, ["event_name", "_node"])
    listed = F.coalesce(F.col("_node").isin(list(q.nodes)), F.lit(False))
    if start_from:
        return _select(rows, F.col("_node")), q.nodes[0]
    if not q.include_others:
        rows = rows.where(listed)
    return _select(rows, F.when(listed, F.col("_node")).otherwise(F.lit(OTHER))), q.nodes[0]


def _select(rows: DataFrame, name: Column) -> DataFrame:
    return rows.select("user_pseudo_id", "session_id", "event_id", "event_timestamp",
                       F.col("day").alias("event_date"), name.alias("name"))


def _merged(rows: DataFrame, q: PathQuery, by: list[str]) -> DataFrame:
    """Merging keeps the last row of each name per session (per user for gap paths).

    That is what the option has always done; `compat=False` merges only rows that
    really follow one another.
    """
    if not q.merge_repeats:
        return rows
    owner = ["user_pseudo_id", "session_id"] if q.by == "session" else ["user_pseudo_id"]
    if q.compat:
        cols = ["event_id", "event_timestamp", "day", "event_name", "session_id", *[c for c in by if c != "event_name"]]
        keys = owner + by
        return keep_one(rows.select(*dict.fromkeys(keys + cols)), keys, ["event_timestamp", "event_id"])
    # Keep the last row of each run: the next row of the owner has another name or does not exist.
    label = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x1e")) for c in by])
    rows = staged(rows, "runs")
    ahead = staged(next_value(rows, owner, "event_timestamp", ["event_id"], label, "_next", borders=crowded(rows, owner, "event_timestamp")), "runs")
    return ahead.where(F.col("_next").isNull() | (F.col("_next") != label)).drop("_next")


def _with_bursts(rows: DataFrame, q: PathQuery) -> DataFrame:
    """Adds the burst number: rows of one user closer than the lag to their neighbour.

    In compat mode the break is marked on the last row before a gap, so that row
    opens the next group; otherwise on the first row after it.
    """
    user, rest = ["user_pseudo_id"], ["event_id", "name"]
    seconds = F.unix_micros("event_timestamp") / 1_000_000
    rows = staged(rows, "path")
    borders = crowded(rows, user, "event_timestamp")
    ahead = next_value(rows, user, "event_timestamp", rest, F.unix_micros("event_timestamp"), "_next", borders=borders)
    wide = F.coalesce(F.col("_next") / 1_000_000 - seconds >= q.lag_seconds, F.lit(True))
    ahead = staged(ahead.withColumn("_break", F.when(wide, 1).otherwise(0)).drop("_next"), "breaks")
    summed = running_sum(ahead, user, "event_timestamp", rest, F.col("_break"), "_group", borders=borders)
    if not q.compat:
        summed = summed.withColumn("_group", F.col("_group") - F.col("_break"))
    return summed.drop("_break")


def _edges(rows: DataFrame, keys: list[str], anchor: str, q: PathQuery) -> DataFrame:
    """Edges from the first anchor of each group on, at most `max_step` steps deep.

    The anchor is a partial aggregate; rows behind it are cut to the first
    `max_step` per group by a row number filter, which Spark turns into a group
    limit on both sides of the shuffle, so a long group never piles up.
    """
    at = F.struct(*ORDER)
    anchors = rows.where(F.col("name") == anchor).groupBy(*keys).agg(F.min(at).alias("_anchor"))
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    top = (
        rows.join(anchors, keys).where(at >= F.col("_anchor")).drop("_anchor")
        .withColumn("_step", F.row_number().over(w)).where(F.col("_step") <= q.max_step)
    )
    after = F.lead("name").over(w)
    following = (F.col("_step") + 1).cast("string")
    edges = top.select(
        "event_date",
        F.concat(F.col("name"), F.lit("_"), F.col("_step").cast("string")).alias("source"),
        F.concat(F.coalesce(after, F.lit("lost")), F.lit("_"), following).alias("target"),
        F.col("event_id" if q.method == EVENT_CNT else "user_pseudo_id").alias("x_id"),
        "_step",
    )
    return edges.where(F.col("_step") < q.max_step).drop("_step")


def _path(rows: DataFrame, anchor: str, q: PathQuery) -> DataFrame:
    if q.by == "session":
        return _edges(rows, ["user_pseudo_id", "session_id"], anchor, q)
    return _edges(staged(_with_bursts(rows, q), "bursts"), ["user_pseudo_id", "_group"], anchor, q)


def event_path(view: DataFrame, q: PathQuery) -> DataFrame:
    return _path(*_event_rows(view, q), q)


def node_path(view: DataFrame, q: PathQuery) -> DataFrame:
    return _path(*_node_rows(view, q), q)


def path_counts(edges: DataFrame) -> DataFrame:
    """Weight of each edge, as the flow chart shows it."""
    return edges.groupBy("event_date", "source", "target").agg(F.countDistinct("x_id").alias("count"))
