"""Attribution weights and paths against straightforward loops."""

import dataclasses
import datetime as dt
from collections import defaultdict

import pytest

from eventloom.operators.explore import attribution as at
from eventloom.operators.explore import path as pa
from eventloom.operators.explore.model import AttributionQuery, PathQuery, Scope, Step
from fixtures import frame, random_events

SCOPE = Scope.days("2024-01-01", "2024-01-04")
A = AttributionQuery(SCOPE, target=Step("c"), touches=(Step("a"), Step("b")), window_seconds=30 * 3600)


def by_conversion(rows, window):
    """Touches of each conversion: those since the conversion before, inside the window."""
    out = {}
    for user in {r["user_pseudo_id"] for r in rows}:
        mine = sorted((r for r in rows if r["user_pseudo_id"] == user), key=lambda r: (r["event_timestamp"], r["event_id"]))
        pending = []
        for r in mine:
            if r["event_name"] == "c":
                near = [p for p in pending if (r["event_timestamp"] - p["event_timestamp"]).total_seconds() <= window]
                if near:
                    out[r["event_id"]] = near
                pending = []
            else:
                pending.append(r)
    return out


def share(model, n, i):
    if model == "LAST":
        return float(i == n - 1)
    if model == "FIRST":
        return float(i == 0)
    if model == "LINEAR":
        return 1 / n
    return 1.0 if n == 1 else 0.5 if n == 2 else 0.4 if i in (0, n - 1) else 0.2 / n


@pytest.mark.parametrize("model", ["LAST", "FIRST", "LINEAR", "POSITION"])
def test_contributions(spark, model):
    rows = random_events(21, 150)
    found = by_conversion(rows, 30 * 3600)
    want = defaultdict(float)
    for touches in found.values():
        for i, t in enumerate(touches):
            want[{"a": "1_a", "b": "2_b"}[t["event_name"]]] += share(model, len(touches), i)
    got = {r["touch_point_name"]: r for r in at.attribution(frame(spark, rows), dataclasses.replace(A, model=model)).collect()}
    assert {k: round(r["contribution"], 9) for k, r in got.items()} == {k: round(v, 9) for k, v in want.items() if v}
    assert abs(sum(r["contribution_rate"] for r in got.values()) - 1) < 1e-9
    assert {r["total_conversions"] for r in got.values()} == {sum(r["event_name"] == "c" for r in rows)}
    if model != "POSITION":
        assert abs(sum(r["contribution"] for r in got.values()) - len(found)) < 1e-9


def test_day_window_compat_keeps_every_touch(spark):
    df = frame(spark, random_events(22, 150))
    day = dataclasses.replace(A, window="CURRENT_DAY", window_seconds=None)
    same_day, all_days = at.touches(df, day).collect(), at.touches(df, dataclasses.replace(day, compat=True)).collect()
    assert all(r["event_timestamp"].date() == r["conversion_time"].date() for r in same_day)
    assert len(all_days) > len(same_day)


@pytest.mark.parametrize("by,compat", [("session", True), ("gap", True), ("gap", False)])
def test_paths(spark, by, compat):
    rows = random_events(23, 150)
    lag = 5 * 3600
    q = PathQuery(SCOPE, steps=(Step("a"), Step("b")), by=by, lag_seconds=lag, max_step=4, compat=compat)
    groups = defaultdict(list)
    for user in {r["user_pseudo_id"] for r in rows}:
        mine = sorted((r for r in rows if r["user_pseudo_id"] == user and r["event_name"] in "ab"),
                      key=lambda r: (r["event_timestamp"], r["event_id"]))
        number = 0
        for i, r in enumerate(mine):
            gap = (mine[i + 1]["event_timestamp"] - r["event_timestamp"]).total_seconds() if i + 1 < len(mine) else None
            breaks = gap is None or gap >= lag
            if by == "session":
                groups[r["session_id"]].append(r)
            else:
                # Compat counts the row before a gap into the group after it.
                groups[(user, number + breaks if compat else number)].append(r)
                number += breaks
    want = []
    for members in groups.values():
        names = [m["event_name"] for m in members]
        if "a" not in names:
            continue
        tail = members[names.index("a"):]
        for i, m in enumerate(tail[:3]):
            after = tail[i + 1]["event_name"] if i + 1 < len(tail) else "lost"
            want.append((m["event_timestamp"].strftime("%Y-%m-%d"), f"{m['event_name']}_{i + 1}", f"{after}_{i + 2}", m["user_pseudo_id"]))
    assert sorted(tuple(r) for r in pa.event_path(frame(spark, rows), q).collect()) == sorted(want)


def test_long_groups_are_cut_before_the_shuffle(spark):
    q = PathQuery(SCOPE, steps=(Step("a"), Step("b")), max_step=4)
    plan = pa.event_path(frame(spark, random_events(24)), q)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_relative_scope_uses_the_given_now(spark):
    now = dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc)
    q = dataclasses.replace(A, scope=Scope.last(1, "DD", now), window_seconds=3600)
    got = at.touches(frame(spark, random_events(25, 150)), q).collect()
    assert all(now.replace(hour=0) <= r["conversion_time"].replace(tzinfo=dt.timezone.utc) <= now for r in got)
