"""What queries compute once and store before several steps read it."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventloom.catalog import etl, functions, streams
from eventloom.session import prepare, staged

KINDS = ["view", "click", "signup", "error", "purchase"]


@pytest.fixture
def folder(spark, tmp_path):
    prepare(spark)
    start = dt.datetime(2024, 1, 14, tzinfo=dt.timezone.utc)
    rows = [(n, start + dt.timedelta(minutes=30 * n), n % 5, KINDS[n % 5], float(n), json.dumps({"k": n % 40})) for n in range(80)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_metrics_read_stored_facts(spark, folder, monkeypatch):
    """The facts of sessions and users are no plan that every metric runs again."""
    seen = []

    def stop(s, events, users, *rest):
        seen.extend([plan(events), plan(users)])
        raise KeyboardInterrupt

    monkeypatch.setattr(functions, "refresh_all", stop)
    with pytest.raises(KeyboardInterrupt):
        functions._run_all(spark, folder)
    assert len(seen) == 2 and not any("Join" in p or "Aggregate" in p for p in seen), seen


def test_user_state_parses_once(spark, folder):
    found = etl.QUERIES["user_state"](spark, folder)
    assert "ArrowEvalPython" not in plan(found) and found.count() == 5


def test_traffic_source_stores_what_it_reads(spark, folder, monkeypatch):
    stored = []
    monkeypatch.setattr(etl, "staged", lambda rows, name: stored.append(rows.columns) or staged(rows, name))
    found = etl.QUERIES["traffic_source"](spark, folder)
    assert len(stored) == 1 and "custom_parameters" not in stored[0] and set(found.columns) <= set(stored[0])
    assert found.count() == etl.stored(spark, folder).count() > 60


def test_the_stream_of_users_is_dealt_to_as_many_tasks_as_a_shuffle_has(spark, folder, monkeypatch):
    paths, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    of_files = streams.jobs.file_stream
    monkeypatch.setattr(streams.jobs, "file_stream", lambda s, path, *a, **k: paths.append(path) or of_files(s, path, *a, **k))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows, _ = streams._parsed_stream(spark, folder)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "ArrowEvalPython" not in plan(rows)
    dealt = spark.read.parquet(paths[0])
    assert len(dealt.inputFiles()) == 8 and dealt.count() == rows.count()
