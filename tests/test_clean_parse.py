import base64
import datetime as dt
import gzip
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventloom.functions.text import max_bytes
from eventloom.operators import clean, fields, tables
from eventloom.operators.parse import parse_events, time_shift
from eventloom.sources.raw import RAW_SCHEMA

NOW = 1_700_000_000_000
EVENT = {"app_id": "a", "unique_id": "u1", "event_id": "e1", "event_type": "_page_view", "timestamp": NOW - 1000, "platform": "Web",
         "zone_offset": 0, "attributes": {"_session_id": "s1", "_page_url": "https://x.org/p?q=1", "mine": 1.5, "list": [1, 2]}}


def upload(spark, *datas, ingest=NOW, uri="/collect?event_bundle_sequence_id=4", **more):
    rows = [{"data": d, "rid": f"r{i}", "ingest_time": ingest, "uri": uri, "ip": "1.2.3.4", "ua": "x", **more} for i, d in enumerate(datas)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def pack(text):
    return base64.b64encode(gzip.compress(text.encode())).decode()


def event(**changes):
    return json.dumps([{k: v for k, v in {**EVENT, **changes}.items() if v is not None}])


def test_payload_forms_and_reject_reasons(spark):
    df = upload(spark, event(), pack(event(event_id="e2")), "  " + event(event_id="e3") + "\n", None, "not base64", "[{bad}]",
                event(event_id=None), event(app_id=None), event(timestamp=None), json.dumps([EVENT, {**EVENT, "event_id": "e4"}]))
    good, bad = clean.split_corrupt(clean.parse_uploads(df))
    assert sorted(r["e"]["event_id"] for r in good.collect()) == ["e1", "e1", "e2", "e3", "e4"]
    assert sorted((r["rid"], r["reason"]) for r in bad.collect()) == [
        ("r3", "corrupt"), ("r4", "corrupt"), ("r5", "corrupt"), ("r6", "event_id"), ("r7", "app_id"), ("r8", "timestamp")]


def test_freshness_and_apps(spark):
    hour = 3_600_000
    df = upload(spark, event(), event(event_id="late", timestamp=NOW - 73 * hour), event(event_id="edge", timestamp=NOW - 72 * hour),
                event(event_id="future", timestamp=NOW + hour), event(event_id="first", event_type="_first_open", timestamp=NOW + hour),
                event(event_id="other", app_id="b"))
    good, _ = clean.clean(df, ["a"], NOW)
    assert sorted(r["e"]["event_id"] for r in good.collect()) == ["e1", "edge", "first"]


def parsed(spark, *datas, enabled=False, **more):
    good, _ = clean.split_corrupt(clean.parse_uploads(upload(spark, *datas, **more)))
    return parse_events(time_shift(good, NOW, enabled))


def test_flat_event(spark):
    row = parsed(spark, event(event_value=2.5)).first()
    assert (row["session_id"], row["page_view_hostname"], row["event_value_currency"], row["event_bundle_sequence_id"]) == (
        "s1", "x.org", "USD", 4)
    assert row["page_view_page_url_query_parameters"] == {"q": "1"}
    assert {k: tuple(v) for k, v in row["custom_parameters"].items()} == {"mine": ("1.5", "number"), "list": ("[1,2]", "object")}


@pytest.mark.parametrize("upload_at,enabled,event_at,want", [
    (NOW - 700_000, True, NOW - 800_000, NOW - 100_000), (NOW - 700_000, False, NOW - 5000, NOW - 5000),
    (NOW - 600_000, True, NOW - 5000, NOW - 5000), (NOW + 900_000, False, NOW + 800_000, NOW - 100_000),
    (NOW + 1000, False, NOW + 800_000, NOW), (None, True, NOW + 5000, NOW)])
def test_time_shift(spark, upload_at, enabled, event_at, want):
    uri = "/collect" + (f"?upload_timestamp={upload_at}" if upload_at else "")
    row = parsed(spark, event(timestamp=event_at), enabled=enabled, uri=uri).first()
    # A shifted clock that still lies in the future takes the ingest time.
    assert row["event_time_msec"] == min(want, NOW)
    assert (row["process_info"]["event_timestamp_adjusted"] == "true") == (min(want, NOW) != event_at)


def test_items_without_id_and_without_items(spark):
    items = [{"id": "i1", "price": "3.5", "mine": "x"}, {"id": "i1", "price": 4}, {"name": "lost"}, {"item_id": "", "price": 1}]
    df = parsed(spark, event(items=items), event(event_id="e2"))
    assert [(r["item_id"], r["price"], r["custom_parameters"]["mine"]["value"]) for r in tables.extract_items(df).collect()] == [("i1", 3.5, "x")]


def test_users_do_not_depend_on_batches(spark):
    user = lambda n, t: {"_user_id": {"value": n, "set_timestamp": t}}
    datas = [event(event_id="1", event_type="_profile_set", timestamp=NOW - 50, user=user("m1", 1)),
             event(event_id="2", event_type="_profile_set", timestamp=NOW - 10, user=user("m2", 2)),
             event(event_id="3", event_type="_first_open", timestamp=NOW - 90, attributes={"_page_referrer": "r1"}),
             event(event_id="4", event_type="_first_open", timestamp=NOW - 80, attributes={"_page_referrer": "r2"})]
    part = lambda *i: tables.partial_users(tables.user_rows(parsed(spark, *[datas[j] for j in i])))
    whole = tables.finish_users(part(0, 1, 2, 3)).drop("process_info").collect()
    for first, second in [((0, 2), (1, 3)), ((1, 3), (0, 2)), ((3,), (0, 1, 2))]:
        merged = tables.merge_user_state(part(*second), part(*first)).drop("process_info").collect()
        assert merged == whole
    assert (whole[0]["user_id"], whole[0]["first_referrer"], whole[0]["user_properties"]["_user_id"]["value"]) == ("m2", "r1", "m2")


@pytest.mark.parametrize("limit", [1, 2, 3, 5, 8])
def test_cut_bytes_keeps_whole_characters(spark, limit):
    texts = ["", "abc", "é", "aé", "日本語", "a日b", "😀x", "ab😀", None]
    got = max_bytes(spark.createDataFrame([(t,) for t in texts], "t string"), {"t": limit}).collect()
    for text, row in zip(texts, got):
        want = text
        if text is not None:
            want = text[:limit]
            while len(want.encode()) > limit:
                want = want[:-1]
            want = text if len(text.encode()) <= limit else want
        assert (row["t"], row["t_truncated"]) == (want, text is not None and len(text.encode()) > limit)


def test_field_rules(spark):
    df = spark.createDataFrame([("e", "n", "a", "u", "p", 1, 2), ("e", "n", "b", "u", "p", 1, 2), ("e", "n", "c", "u", "p", 1, 2)],
                               "event_id string, event_name string, app_id string, user_pseudo_id string, platform string, x int, y int")
    white, black = fields.FieldRule("whitelist", ("x",)), fields.FieldRule("blacklist", ("x", "event_id"))
    assert fields.field_filter(df, white).columns == ["event_id", "event_name", "app_id", "user_pseudo_id", "platform", "x"]
    assert fields.field_filter(df, black).columns == ["event_id", "event_name", "app_id", "user_pseudo_id", "platform", "y"]
    assert fields.field_filter(df, fields.FieldRule("whitelist")).columns == df.columns[:5]
    got = {r["app_id"]: (r["x"], r["y"]) for r in fields.apply_field_rules(df, {"a": white, "b": black}, ["a", "b"]).collect()}
    assert got == {"a": (1, None), "b": (None, 2), "c": (1, 2)}


def test_uploads_reach_python_in_bounded_batches(spark):
    def size(texts: pd.Series) -> pd.Series:
        return texts.map(lambda _: len(texts))

    seen = F.pandas_udf(size, "long")
    many = spark.range(0, 3_000, 1, 1).select(seen(F.concat(F.lit("x"), "id")).alias("n"))
    assert many.agg(F.max("n")).first()[0] <= 200
    long = spark.range(0, 60, 1, 1).select(seen(F.concat(F.repeat(F.lit("x"), 1_000_000), "id")).alias("n"))
    assert long.agg(F.max("n")).first()[0] <= 6
