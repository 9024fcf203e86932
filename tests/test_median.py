"""Exact medians against a plain version; groups of one key lie over several partitions."""

import random
import statistics

from pyspark.sql import functions as F

from compare import DATA
from eventloom import catalog
from eventloom.operators.median import exact_medians


def test_against_statistics(spark):
    rnd = random.Random(2)
    rows = [("big", rnd.choice([1.5, 2.5, 7.0, -3.0, rnd.random() * 100])) for _ in range(4001)]
    rows += [("even", float(k)) for k in range(10)] + [("one", 4.0), ("none", None), (None, 2.0), (None, 4.0), (None, None)]
    rows += [("ties", 5.0)] * 3000 + [("ties", 6.0)]
    found = {r.k: r.median for r in exact_medians(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    plain = {}
    for k, v in rows:
        plain.setdefault(k, []).extend([] if v is None else [v])
    assert found == {k: statistics.median(v) if v else None for k, v in plain.items()}
    assert exact_medians(spark.createDataFrame([], "k string, v double"), ["k"], "v").count() == 0


def test_no_group_is_buffered(spark):
    plan = catalog.queries()["event_property"](spark, DATA.format("0.001"))._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "median(" not in plan


def test_distinct_counts_copy_no_event(spark):
    for key in ("event_daily", "event_hourly"):
        plan = catalog.queries()[key](spark, DATA.format("0.001"))._jdf.queryExecution().optimizedPlan().toString()
        above = plan[:plan.index("Expand")]
        # What is expanded are distinct (user, session) pairs, not events.
        assert plan.count("Expand") == 1 and "event_id" not in plan[len(above):].splitlines()[0], plan


def test_page_details_copy_no_row_per_count(spark):
    plan = catalog.queries()["page_view_detail"](spark, DATA.format("0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_distinct_counts_of_repeated_and_null_ids(spark):
    from eventloom.operators.metrics.activity import _summary

    rows = [("k", "_page_view", "e1", "u1", "s1"), ("k", "_page_view", "e1", "u2", "s1"), ("k", "_page_view", None, "u2", None), (None, "x", "e2", None, "s2")]
    df = spark.createDataFrame(rows, "app_id string, event_name string, event_id string, user_pseudo_id string, session_id string")
    found = {(r.app_id, r.event_count, r.user_count, r.session_count, r.view_count) for r in _summary(df.withColumn("x", F.lit(1)), "app_id", "event_name").collect()}
    assert found == {("k", 1, 2, 1, 1), (None, 1, 0, 1, 0)}
