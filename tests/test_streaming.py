"""Streams over restarts, replays and late events."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventloom.catalog import streams
from eventloom.operators import sessions, tables
from eventloom.sources.partials import PartialLog
from eventloom.streaming import jobs
from eventloom.streaming.users import UserPicture

EVENT = "event_id string, event_name string, event_timestamp timestamp, event_time_msec long, ingest_time_msec long"
DAY = 86_400_000


def feed(spark, folder, rows, schema):
    """One more file, a batch of its own."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def run(df, folder, mode="append"):
    jobs._start(df.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/out"), f"{folder}/check", True).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def event(n, name, day, ingested=None):
    msec = day * DAY
    return f"e{n}", name, dt.datetime.fromtimestamp(msec / 1000, dt.timezone.utc), msec, (msec if ingested is None else int(ingested * DAY))


def test_a_late_event_of_the_three_names_passes_a_stateful_step(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "in").mkdir()
    stream = jobs.file_stream(spark, f"{folder}/in", EVENT, files_per_batch=1)
    feed(spark, f"{folder}/in", [event(1, "_click", 100), event(2, "_first_open", 100)], EVENT)
    feed(spark, f"{folder}/in", [event(3, "_click", 120), event(3, "_click", 120), event(4, "_first_open", 120)], EVENT)
    feed(spark, f"{folder}/in", [event(5, "_click", 121)], EVENT)
    # In time by the row's own clocks, but behind the watermark; and two of the names that always pass, far behind it.
    feed(spark, f"{folder}/in", [event(6, "_click", 101, 102), event(7, "_first_open", 2, 121), event(7, "_first_open", 2, 121), event(8, "_profile_set", 101, 121)], EVENT)
    out = run(jobs.late_dedupe(stream, F.lit("2030-01-01").cast("timestamp")), folder)
    assert sorted(r.event_id for r in out.collect()) == ["e1", "e2", "e3", "e4", "e5", "e7", "e8"]


PARSED = ("app_id string, user_pseudo_id string, event_timestamp timestamp, event_id string, event_name string, user_id string, "
          "user_properties map<string,struct<value:string,type:string,set_time_msec:bigint>>, user_first_touch_time_msec bigint, "
          "page_view_latest_referrer string, page_view_page_referrer string, app_install_source string, process_info map<string,string>, "
          + ", ".join(f"traffic_source_{f} string" for f in tables.TRAFFIC_FIELDS))


def parsed(user, hours, name, user_id=None, tier=None, source=None):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hours)
    props = None if tier is None else {"tier": (tier, "string", int(hours))}
    return ("a", user, at, f"e{hours}", name, user_id, props, int(hours), None, None, None, {"n": str(hours)}, *[source] * len(tables.TRAFFIC_FIELDS))


def picture(df):
    return {r.user_pseudo_id: (r.user_id, r.first_traffic_source, r.user_properties and r.user_properties["tier"]["value"], r.event_timestamp.day)
            for r in df.collect()}


def test_user_state_expires_and_survives_a_restart(spark, tmp_path):
    folder = str(tmp_path)

    def go():
        stream = jobs.file_stream(spark, f"{folder}/in", PARSED, files_per_batch=1).withWatermark("event_timestamp", "1 hour")
        return run(jobs.users_with_ttl(stream, dt.timedelta(hours=48)), folder)

    feed(spark, f"{folder}/in", [parsed("x", 0, "_first_open", "m1", source="ad"), parsed("y", 1, "_first_open", "m2", source="mail"),
                                 parsed("x", 2, "_profile_set", tier="gold")], PARSED)
    assert picture(jobs.current_users(go())) == {"x": ("m1", "ad", "gold", 1), "y": ("m2", "mail", None, 1)}
    feed(spark, f"{folder}/in", [parsed("x", 40, "_screen_view", source="other")], PARSED)  # a new run goes on from the checkpoint
    out = go()
    assert picture(jobs.current_users(out))["x"] == ("m1", "ad", "gold", 2)
    assert out.filter("user_pseudo_id = 'y'").count() == 1  # a batch writes its own users only
    feed(spark, f"{folder}/in", [parsed("z", 200, "_first_open")], PARSED)
    feed(spark, f"{folder}/in", [parsed("y", 201, "_screen_view", source="third"), parsed("x", 202, "_profile_set", tier="tin")], PARSED)
    now = picture(jobs.current_users(go()))
    assert now["y"] == (None, "third", None, 9) and now["x"] == (None, None, "tin", 9) and now["z"][3] == 9


def users(rows):
    return tables.partial_users(tables.user_rows(rows))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    first = spark.createDataFrame([parsed("x", 0, "_first_open", "m1", source="ad"), parsed("y", 1, "_first_open")], PARSED)
    second = spark.createDataFrame([parsed("x", 5, "_profile_set", tier="gold")], PARSED)
    log = jobs.user_log(spark, f"{tmp_path}/log", users(first).schema)
    assert log.read().count() == 0
    log.append(users(first), 0)
    # The driver is lost while batch 1 writes: files without the mark of completion.
    users(second).withColumn("batch", F.lit(1)).write.parquet(f"{tmp_path}/log/batches/1")
    (tmp_path / "log/batches/1/_SUCCESS").unlink()
    assert picture(tables.finish_users(log.read())) == {"x": ("m1", "ad", None, 1), "y": (None, None, None, 1)}
    log.append(users(second), 1)
    before = picture(tables.finish_users(log.read()))
    files = sorted(tmp_path.rglob("*.parquet"))
    log.append(users(second), 1)
    assert sorted(tmp_path.rglob("*.parquet")) == files and before == {"x": ("m1", "ad", "gold", 1), "y": (None, None, None, 1)}
    log.compact()
    assert picture(tables.finish_users(log.read())) == before
    log.append(users(spark.createDataFrame([parsed("y", 9, "_profile_set", tier="tin")], PARSED)), 2)
    assert picture(tables.finish_users(log.read()))["y"] == (None, None, "tin", 1)
    log.compact()
    assert log.rows().count() == 2


@pytest.mark.parametrize("sources", [["Direct", None, "Direct"], [None, None], ["Direct", "ad", "mail"], [None, "Direct", None, "ad"], ["ad", "Direct"], [None]])
def test_folding_batches_is_merging_them_in_order(spark, tmp_path, sources):
    schema = "app_id string, user_pseudo_id string, session_id string, event_timestamp timestamp, created_time timestamp, session_source string"
    at = dt.datetime(2024, 1, 1)
    batches = [spark.createDataFrame([("a", "u", "s", at + dt.timedelta(hours=k), at, source)], schema) for k, source in enumerate(sources)]
    log = PartialLog(spark, str(tmp_path), batches[0].schema, sessions.fold_batches)
    stored = batches[0].limit(0)
    for k, rows in enumerate(batches):
        stored = sessions.merge_sessions(stored, rows)
        log.append(rows, k)
        if k == 1:
            log.compact()
    assert log.read().drop("batch").collect() == stored.collect()


def test_a_user_costs_few_calls_to_the_state_store():
    """One read, one write and a timer only where it moves."""
    class Store:
        def __init__(self):
            self.calls, self.value, self.timers = [], None, set()

        def __getattr__(self, name):
            def call(*args):
                self.calls.append(name)
                if name == "getValueState":
                    return self
                if name == "update":
                    self.value = args[0]
                if name == "exists":
                    return self.value is not None
                if name == "registerTimer":
                    self.timers.add(args[0])
                if name == "deleteTimer":
                    self.timers.remove(args[0])
                return iter(sorted(self.timers)) if name == "listTimers" else self.value
            return call

    def row(at):
        return Row(at=at, user_id=None, info=None, event_id=f"e{at}", first=None, latest=None)

    store, picture = Store(), UserPicture(dt.timedelta(seconds=1))
    picture.init(store)
    told = []
    for ats, calls in (([5_000_000, 5_500_000], 3), ([5_200_000], 2), ([5_900_000], 4)):
        store.calls.clear()
        out = list(picture.handleInputRows(("a", "u"), iter([row(at) for at in ats]), None))
        told.append((out[0]["seen"], out[0]["version"], sorted(store.timers)))
        assert len(store.calls) == calls, store.calls
    assert told == [(5_500_000, 1, [6501]), (5_500_000, 2, [6501]), (5_900_000, 3, [6901])]


def test_a_period_is_one_batch_however_many_tasks_wrote_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "scratch", lambda s, name: f"{tmp_path}/{name}")
    days = spark.range(40).selectExpr("id", "timestamp'2024-01-01' + make_dt_interval(cast(id AS int)) AS at").repartition(4)
    seen = streams._in_runs(spark, days, "at", ["2024-01-11", "2024-01-31"], lambda stream: stream)
    assert sorted(r.id for r in seen.collect()) == list(range(40))
    assert len(list((tmp_path / "periods").glob("*.parquet"))) > 3
    assert sorted(p.name for p in (tmp_path / "check" / "commits").glob("[0-9]*")) == ["0", "1", "2"]
