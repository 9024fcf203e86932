"""Registered queries against their oracle on the smallest tables, and the shape of their plans."""

import pytest

from compare import DATA, compare, duck
from eventloom import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracles()
# A few of every kind; --all-queries compares all of them.
QUICK = ["event_daily", "dau", "new_return_tz", "session_analysis", "engagement_kpi_tz", "retention_daily", "page_view_wh",
         "acquisition", "lifecycle_state", "meta_user_attrs", "event_property", "explore_retention", "parse_web_tag", "user_profile_v1",
         "merge_sessions", "upsert_replace", "fn_datetime", "stream_dedupe"]


def pytest_generate_tests(metafunc):
    if "key" in metafunc.fixturenames:
        everything = metafunc.config.getoption("--all-queries")
        metafunc.parametrize("key", sorted(ORACLES) if everything else QUICK)


@pytest.fixture(scope="module")
def con():
    return duck(DATA.format("0.001"))


def test_equal(spark, con, key):
    problem = compare(spark, con, DATA.format("0.001"), QUERIES[key], ORACLES[key])
    assert problem == "", problem


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


@pytest.mark.parametrize("method", ["USER_ID_CNT", "EVENT_CNT"])
def test_funnel_plans_do_not_grow_with_their_steps(spark, method):
    """Every step is written once; what is left to plan is the same for two steps and for eight."""
    from eventloom.catalog import base, explore
    from eventloom.operators.explore import funnel
    from eventloom.operators.explore.model import FunnelQuery, Step

    view = base.user_events(spark, DATA.format("0.001"))
    names = ["_first_open", "_screen_view", "_session_start", "purchase"] * 2
    found = [scans(funnel.funnel_table(view, FunnelQuery(explore.SCOPE, steps=tuple(Step(x) for x in names[:n]), method=method,
                                                         window_seconds=86_400))) for n in (2, 5, 8)]
    assert found[0] <= 8 and (found[0] >= found[2] or method == "EVENT_CNT" and found[2] - found[0] <= 6), found


@pytest.mark.parametrize("name", ["event_daily", "retention_daily", "acquisition_wh", "lifecycle_state", "page_view_detail", "funnel_table",
                                  "funnel_table_events", "path_gap", "node_path_session", "attribution_linear", "explore_retention",
                                  "meta_event_params", "traffic_source", "geo_ip", "extract_users", "backfill_event", "merge_sessions"])
def test_no_pairing_and_no_single_task(spark, name):
    plan = QUERIES[name](spark, DATA.format("0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A sort or window over everything in one task; global totals of a few rows are aggregates.
    for line in plan.splitlines():
        assert not ("Window" in line and "Window [" in line and ", []" in line.split("windowspecdefinition")[0]), line
