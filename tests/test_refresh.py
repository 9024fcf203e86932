"""Metric tables over several runs: only what is touched changes, a repeated run changes nothing, a failed table catches up."""

import datetime as dt
import threading

from pyspark.sql import functions as F

from compare import DATA
from eventloom.adapt import with_session_facts
from eventloom.catalog import base as b
from eventloom.plans.modelling import METRICS, Metric
from eventloom.plans.refresh import last_run, refresh_all

SF = DATA.format("0.001")
CUT, END = dt.datetime(2024, 1, 20, 12), dt.datetime(2024, 3, 1)


def files(folder):
    found = {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("part-*")}
    return {k: v for k, v in found.items() if "_batches" not in k and "_runs" not in k}


def content(spark, folder, name):
    return sorted(map(str, spark.read.parquet(f"{folder}/{name}").drop("bucket").collect()))


def test_runs(spark, tmp_path):
    chosen = {k: METRICS[k] for k in ("dau", "wau", "user_behavior", "retention_daily")}
    events, users = b.events(spark, SF), b.users(spark, SF)
    events = events.withColumn("created_time", F.when(F.col("event_timestamp") < "2024-01-18", F.lit("2024-01-18").cast("timestamp")).otherwise(F.col("created_time")))
    broken = Metric(lambda e, u: e.select("no_such_column"), (), "event_date")
    root = tmp_path / "tables"
    failures = refresh_all(spark, with_session_facts(events.where(F.col("created_time") <= F.lit(CUT))), users, str(root), CUT, {**chosen, "mau": broken})
    assert list(failures) == ["mau"] and last_run(spark, str(root), "mau") is None and last_run(spark, str(root), "dau") == CUT
    first = files(root)
    facts = with_session_facts(events)
    assert refresh_all(spark, facts, users, str(root), CUT, chosen) == {} and files(root) == first  # nothing new
    assert refresh_all(spark, facts, users, str(root), END, {**chosen, "mau": METRICS["mau"]}) == {}
    second = files(root)
    kept = [k for k in first if second.get(k) == first[k]]
    assert any("dau/event_date=2024-01-05" in k for k in kept) and any("wau/week_start=2024-01-08" in k for k in kept)
    assert not any("dau/event_date=2024-01-25" in k for k in kept)
    fresh = tmp_path / "fresh"
    assert refresh_all(spark, facts, users, str(fresh), END, {**chosen, "mau": METRICS["mau"]}) == {}
    for name in [*chosen, "mau"]:
        assert content(spark, root, name) == content(spark, fresh, name) != [], name


def test_metrics_are_built_side_by_side_and_failures_keep_their_order(spark, tmp_path):
    meet = threading.Barrier(2, timeout=60)

    def met(events, users):
        meet.wait()
        return events.groupBy("app_id").count()

    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 2))], "app_id string, created_time timestamp")
    metrics = {"z": Metric(lambda e, u: e.select("nothing"), (), ""), "one": Metric(met, ("app_id",), "app_id"),
               "two": Metric(met, ("app_id",), "app_id"), "y": Metric(lambda e, u: e.select("nothing"), (), "")}
    failed = refresh_all(spark, rows, rows, str(tmp_path), dt.datetime(2024, 2, 1), metrics)
    assert list(failed) == ["z", "y"]
    assert all(spark.read.parquet(f"{tmp_path}/{name}").count() == 2 for name in ("one", "two"))
