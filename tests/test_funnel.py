"""Funnels against an enumeration of all chains."""

import datetime as dt
from collections import defaultdict
from zoneinfo import ZoneInfo

import pytest

from eventloom.operators.explore import funnel
from eventloom.operators.explore.model import EVENT_CNT, USER_ID_CNT, Attribute, FunnelQuery, Grouping, Scope, Step
from fixtures import frame, random_events

SCOPE = Scope.days("2024-01-01", "2024-01-04")
STEPS = (Step("a"), Step("b"), Step("c"))


def chains(rows, window, tz="UTC", same=()):
    """All (start, ..., reached) prefixes by nested loops."""
    day = lambda r: r["event_timestamp"].astimezone(ZoneInfo(tz)).date()
    for s in (r for r in rows if r["event_name"] == "a"):
        level = [[s]]
        yield level[0]
        for name in "bc":
            level = [c + [r] for c in level for r in rows
                     if r["event_name"] == name and r["user_pseudo_id"] == s["user_pseudo_id"]
                     and r["event_timestamp"] > c[-1]["event_timestamp"] and all(r[k] == s[k] for k in same)
                     and ((r["event_timestamp"] - s["event_timestamp"]).total_seconds() <= window if window
                          else day(r) == day(s))]
            yield from level


def counts(rows, window, x, label=None, tz="UTC", same=()):
    seen = defaultdict(lambda: [set(), set(), set()])
    for c in chains(rows, window, tz, same):
        seen[label(c[0]) if label else None][len(c) - 1].add(c[-1][x])
    return {k: [len(v) for v in sets] for k, sets in seen.items()}


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("method,x", [(USER_ID_CNT, "user_pseudo_id"), (EVENT_CNT, "event_id")])
@pytest.mark.parametrize("window,tz", [(7200, "UTC"), (40 * 3600, "UTC"), (None, "America/New_York")])
def test_counts_by_day(spark, seed, method, x, window, tz):
    rows = random_events(seed, 90)
    scope = Scope.days("2023-12-31", "2024-01-05")
    q = FunnelQuery(scope, tz, steps=STEPS, method=method, window_seconds=window)
    day = lambda r: r["event_timestamp"].astimezone(ZoneInfo(tz)).strftime("%Y-%m-%d")
    want = counts(rows, window, x, day, tz)
    got = {r["day"]: [r["1_a"], r["2_b"], r["3_c"]] for r in funnel.funnel_table(frame(spark, rows), q).collect()}
    assert got == want
    assert all(c[0] >= c[1] >= c[2] for c in got.values()) or method == EVENT_CNT


def test_groups_on_all_steps_and_on_the_first(spark):
    rows = random_events(13, 100)
    for apply_to, same in (("ALL", ("kind",)), ("FIRST", ())):
        q = FunnelQuery(SCOPE, steps=STEPS, window_seconds=86_400, method=EVENT_CNT,
                        grouping=Grouping((Attribute("kind"),), apply_to))
        want = counts(rows, 86_400, "event_id", lambda r: (r["event_timestamp"].strftime("%Y-%m-%d"), r["kind"]), same=same)
        got = {(r["day"], r["kind"]): [r["1_a"], r["2_b"], r["3_c"]]
               for r in funnel.funnel_table(frame(spark, rows), q).collect()}
        assert got == want


def test_steps_at_the_same_moment_do_not_follow(spark):
    at = dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc)
    base = random_events(1, 2)
    rows = [{**base[0], "event_id": "e1", "event_name": "a", "event_timestamp": at, "user_pseudo_id": "u", "merged_user_id": "u"},
            {**base[1], "event_id": "e2", "event_name": "b", "event_timestamp": at, "user_pseudo_id": "u", "merged_user_id": "u"}]
    q = FunnelQuery(SCOPE, steps=(Step("a"), Step("b")), window_seconds=60)
    assert [r["depth"] for r in funnel.funnel_starts(frame(spark, rows), q).collect()] == [1]
    rows[1]["event_timestamp"] = at + dt.timedelta(seconds=60)
    assert [r["depth"] for r in funnel.funnel_starts(frame(spark, rows), q).collect()] == [2]


def test_hourly_event_counts_over_a_long_window(spark):
    """Every (start, event) pair by hand; the plan holds no list of labels for an event."""
    from compare import DATA
    from eventloom.catalog import base as b

    names, window = ["_first_open", "_screen_view", "purchase"], 30 * 86_400
    q = FunnelQuery(Scope.days("2024-01-03", "2024-01-28"), "Asia/Shanghai", steps=tuple(Step(n) for n in names), window_seconds=window,
                    method=EVENT_CNT, unit="hour")
    view = b.user_events(spark, DATA.format("0.001"))
    zone = ZoneInfo("Asia/Shanghai")
    users = defaultdict(list)
    for r in view.select("merged_user_id", "event_id", "event_name", "event_timestamp").collect():
        at = r.event_timestamp.replace(tzinfo=dt.timezone.utc) if r.event_timestamp.tzinfo is None else r.event_timestamp
        if "2024-01-03" <= at.astimezone(zone).strftime("%Y-%m-%d") <= "2024-01-28":
            users[r.merged_user_id].append((at, r.event_id, r.event_name))
    seen = defaultdict(lambda: [set(), set(), set()])
    for rows in users.values():
        rows.sort()
        for start, start_id, name in rows:
            if name != names[0]:
                continue
            cell, arrived = seen[start.astimezone(zone).strftime("%Y-%m-%d %H:00")], start
            cell[0].add(start_id)
            for i in (1, 2):
                hits = [(t, e) for t, e, n in rows if n == names[i] and t > arrived and (t - start).total_seconds() <= window]
                if not hits:
                    break
                cell[i] |= {e for _, e in hits}
                arrived = min(hits)[0]
    found = {r["hour"]: [r["1__first_open"], r["2__screen_view"], r["3_purchase"]] for r in funnel.funnel_table(view, q).collect()}
    assert found == {label: [len(x) for x in cell] for label, cell in seen.items()} and len(found) > 50
    assert "sequence(" not in funnel.funnel_table(view, q)._jdf.queryExecution().optimizedPlan().toString()
