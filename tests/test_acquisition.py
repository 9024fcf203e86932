"""Acquisition totals: the groups of a user and day are in one task, whose rows do not grow with the table."""

import collections

import pytest
from pyspark.sql import functions as F

from eventloom.operators.metrics import acquisition

SOURCES = ["traffic_source_source", "traffic_source_medium", "traffic_source_campaign", "traffic_source_clid_platform",
           "traffic_source_channel_group"]


def events(spark, users):
    rows = [(f"e{u}-{k}", f"u{u}" if u else None, f"s{u}-{k // 2}" if k != 5 else None, "app", f"2024-01-0{1 + k % 2} 10:00:00",
             "_page_view" if k % 3 else "_first_open", 100 * k if k % 4 else None, 6000 * k if k % 5 else None, ["a", "b", None][k % 3])
            for u in range(users) for k in range(8)]
    return spark.createDataFrame(
        rows, "event_id string, user_pseudo_id string, session_id string, app_id string, at string, event_name string, "
              "user_engagement_time_msec long, session_duration long, source string").select(
        "*", F.col("at").cast("timestamp").alias("event_timestamp"), F.lit("Web").alias("platform"),
        *[F.col("source").alias(c) for c in SOURCES])


def first_touch(spark, users):
    return spark.createDataFrame([(f"u{u}", "x") for u in range(1, users, 2)], "user_pseudo_id string, x string").select(
        "user_pseudo_id", *[F.col("x").alias(c) for c in acquisition.FIRST_COLUMNS])


def test_no_task_stacks_more_rows_of_a_larger_table(spark, monkeypatch):
    monkeypatch.setattr(acquisition, "ROWS_PER_TASK", 100)
    for users in (50, 200):
        out = acquisition.acquisition(events(spark, users), first_touch(spark, users))
        rows = out.select("event_date", "user_pseudo_id", F.spark_partition_id().alias("task")).collect()
        assert max(collections.Counter(r.task for r in rows).values()) < 2000
        tasks = collections.defaultdict(set)
        for r in rows:
            tasks[r.event_date, r.user_pseudo_id].add(r.task)
        assert all(len(t) == 1 for t in tasks.values())


@pytest.mark.parametrize("rows", [7, 50_000])
def test_sums_of_sums_are_the_sums(spark, monkeypatch, rows):
    monkeypatch.setattr(acquisition, "ROWS_PER_TASK", rows)
    view = events(spark, 6)
    view = view.union(view.limit(9))  # repeated rows: events count once, engagement as often as it is there
    got = {(r.event_date.isoformat(), r.user_pseudo_id, r.aggregation_dim): r
           for r in acquisition.acquisition(view, first_touch(spark, 6)).filter("aggregation_type = 'Session Traffic Source'").collect()}
    sessions = collections.defaultdict(list)
    for r in view.collect():
        sessions[r.at[:10], r.user_pseudo_id, r.source, r.session_id].append(r)
    want = collections.defaultdict(lambda: [0, 0, 0, 0, 0])
    for (day, user, source, session), rs in sessions.items():
        hit = sum(r.event_name == "_page_view" for r in rs) > 1 or max(r.session_duration or 0 for r in rs) > 10_000
        for k, x in enumerate([any(r.event_name == "_first_open" for r in rs), session is not None, hit, len({r.event_id for r in rs}),
                               hit * sum(r.user_engagement_time_msec or 0 for r in rs)]):
            want[day, user, source][k] += x
    assert {k: [r[c] for c in acquisition.SUMS] for k, r in got.items()} == dict(want)
