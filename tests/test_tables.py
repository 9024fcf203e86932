"""Stored tables: upserts, state, the full batch run, streams against batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom import uploads as up
from eventloom.operators import upsert as ups
from eventloom.plans import etl, modelling
from eventloom.session import scratch
from eventloom.sources import ods, state

DATA = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def test_upsert_treats_nulls_as_equal(spark):
    t = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, p string, v int")
    s = spark.createDataFrame([("a", None, 9), ("c", "x", 3)], "k string, p string, v int")
    got = sorted(tuple(r) for r in ups.upsert(t, s, ["k", "p"]).collect())
    assert [r[0] + str(r[2]) for r in got] == ["a9", "b2", "c3"]
    summed = ups.accumulate(t, s, ["k", "p"], {"v": ups.ADD}).collect()
    assert sorted((r["k"], r["v"]) for r in summed) == [("a", 10), ("b", 2), ("c", 3)]


def test_metric_table_changes_only_touched_partitions(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "d date, k string, v int")
    day = lambda n: dt.date(2024, 1, n)
    t = ups.MetricTable(spark, scratch(spark, "t"), rows((day(1), "a", 1)).schema, ["d", "k"], ["d"])
    assert t.read().count() == 0
    t.upsert(rows((day(1), "a", 1), (day(1), "b", 1), (day(2), "a", 1)))
    before = {r["f"] for r in t.read().where("d = DATE '2024-01-01'").select(F.input_file_name().alias("f")).distinct().collect()}
    for _ in range(2):
        t.upsert(rows((day(2), "a", 7), (day(3), "a", 1)))
    after = {r["f"] for r in t.read().where("d = DATE '2024-01-01'").select(F.input_file_name().alias("f")).distinct().collect()}
    assert before == after
    assert sorted((r["d"].day, r["k"], r["v"]) for r in t.read().collect()) == [(1, "a", 1), (1, "b", 1), (2, "a", 7), (3, "a", 1)]


def test_accumulating_twice_counts_twice_but_recomputing_does_not(spark):
    """The accumulating merge is not repeatable; the plain one is, over whole recomputed rows."""
    t = spark.createDataFrame([("u", 5)], "k string, v int")
    twice = ups.accumulate(ups.accumulate(t, t, ["k"], {"v": ups.ADD}), t, ["k"], {"v": ups.ADD})
    assert twice.first()["v"] == 15
    assert ups.upsert(ups.upsert(t, t, ["k"]), t, ["k"]).collect() == t.collect()


def test_state_keeps_days_and_survives_compaction(spark):
    rows = lambda u: spark.createDataFrame([("app", u)], "app_id string, u string")
    s = state.StateTable(spark, scratch(spark, "s"), rows("x").schema, keep_days=10)
    day = lambda n: dt.date(2024, 1, n)
    assert s.read(day(1)).count() == 0
    s.append(rows("old"), day(1))
    s.append(rows("a"), day(15))
    s.append(rows("a"), day(16))
    names = lambda: sorted(r["u"] for r in s.read(day(20)).collect())
    assert names() == ["a", "a"]
    s.compact(lambda df: df.distinct(), day(20))
    s.append(rows("b"), day(20))
    assert names() == ["a", "b"] and s.version() == 1


def test_state_forgets_rows_by_their_own_time(spark):
    at = lambda n: dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)
    rows = lambda u, n: spark.createDataFrame([("app", u, at(n))], "app_id string, u string, seen timestamp")
    s = state.StateTable(spark, scratch(spark, "s"), rows("x", 1).schema, keep_days=10, time="seen")
    s.append(rows("old", 3).unionByName(rows("new", 12)), at(12).date())
    s.compact(lambda df: df, at(12).date())
    assert [r["u"] for r in s.read(at(20).date()).collect()] == ["new"]


def test_a_key_may_not_occur_twice_in_a_change(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError, match="several new rows"):
        ups.MetricTable(spark, scratch(spark, "t"), rows.schema, ["k"], ["k"]).upsert(rows)


def test_equal_clocks_pick_the_same_row(spark):
    from eventloom.operators.dedupe import dedupe_items

    rows = [("u", "e", "i", 1, 5, f"v{k}") for k in range(50)]
    df = spark.createDataFrame(rows, "user_pseudo_id string, event_id string, item_id string, event_timestamp int, created_time int, v string")
    picked = {dedupe_items(df.repartition(n, "v").sortWithinPartitions(F.rand(n))).first()["v"] for n in (1, 3, 7)}
    assert len(picked) == 1


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(far, "x")


@pytest.fixture(scope="module")
def lake(spark):
    """Two batches through the whole run: the first half of the uploads, then the second."""
    out = scratch(spark, "lake")
    all_uploads = up.sdk_uploads(spark, DATA).withColumn("client_timestamp", F.lit(None).cast("string"))
    half = F.substring("rid", 2, 9).cast("int") < 50
    for i, part in enumerate([all_uploads.where(half), all_uploads.where(~half)]):
        etl.run(spark, part, etl.EtlConfig(["app0", "app1"], out, f"job-{i}", AT + dt.timedelta(days=i), up.CATEGORY_RULES))
    return out


def test_batch_run(spark, lake):
    from eventloom.catalog import etl as catalog_etl

    read = lambda t: spark.read.option("basePath", f"{lake}/{t}").parquet(f"{lake}/{t}")
    want = {r["event_id"] for r in catalog_etl.parsed(spark, DATA).select("event_id").collect()}
    events = read("event")
    stored = {r["event_id"] for r in events.select("event_id").collect()}
    bots = {e for e in want if (int(e[1:]) // 10) % 5 == 3}
    assert stored == want - bots and not {"ua", "ip"} & set(events.columns)
    assert spark.read.json(f"{lake}/rejects").count() > 0
    assert events.where("traffic_source_source IS NULL").count() == 0
    whole = {(r["app_id"], r["user_pseudo_id"]): r["first_touch_time_msec"]
             for r in catalog_etl.tables.extract_users(catalog_etl.parsed(spark, DATA)).collect()}
    newest = ods.keep_one(read("user"), ["app_id", "user_pseudo_id"], ["created_time"])
    assert {(r["app_id"], r["user_pseudo_id"]): r["first_touch_time_msec"] for r in newest.collect()} == whole


def test_metric_run_goes_on_after_a_failure(spark):
    events = spark.createDataFrame([("a", AT, "Web", "u")], "app_id string, event_timestamp timestamp, platform string, user_pseudo_id string")
    users = spark.createDataFrame([("u", 0)], "user_pseudo_id string, first_touch_time_msec bigint")
    done = {}
    failed = modelling.run_all(events, users, lambda n, df, m: done.__setitem__(n, df.count()),
                               {n: modelling.METRICS[n] for n in ("page_screen_view", "dau", "retention_daily")})
    assert done["dau"] == 1 and set(failed) == {"page_screen_view"}


def test_saved_batch_files_round_trip_as_json(spark):
    rows = spark.createDataFrame([("a", AT, "1"), ("b", AT, "2")], "app_id string, event_timestamp timestamp, event_id string")
    path = scratch(spark, "json")
    ods.write_ods(rows, path, "json")
    assert spark.read.schema("event_id string, partition_app string, partition_year string, partition_month string, partition_day string"
                             ).json(path).where("partition_app = 'a' AND partition_month = '03'").count() == 1


def test_rows_that_differ_in_a_map_only_are_ordered(spark):
    from eventloom.operators.dedupe import keep_one

    rows = [("k", 1, {"a": str(v)}, [{"x": v}]) for v in range(8)]
    schema = "k string, t long, m map<string,string>, a array<map<string,int>>"
    picked = {str(keep_one(spark.createDataFrame(rows[n:] + rows[:n], schema).repartition(n + 1), ["k"], ["t"]).collect()) for n in range(4)}
    assert len(picked) == 1
