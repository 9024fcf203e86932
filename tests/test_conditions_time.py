import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.functions import timeunits as tu
from eventloom.functions.conditions import compile_conditions
from eventloom.operators.explore.model import EVENT, Attribute, Condition, Conditions, Scope

UTC = dt.timezone.utc


@pytest.fixture(scope="module")
def rows(spark):
    data = [("1", "ab%c", 5.0, "true", {"n": ("7", "number"), "b": ("true", "boolean")}),
            ("2", "abc", None, "false", {"n": ("x", "string"), "b": ("false", "boolean")}),
            ("3", None, 9.0, None, {})]
    return spark.createDataFrame(data, "id string, s string, d double, flag string, "
                                       "custom_parameters map<string,struct<value:string,type:string>>")


S, D, N = Attribute("s"), Attribute("d", data_type="double"), Attribute("n", EVENT, "int")
FLAG, B = Attribute("flag", data_type="boolean"), Attribute("b", EVENT, "boolean")


@pytest.mark.parametrize("attribute,op,values,want", [
    (S, "=", ("abc",), "2"), (S, "<>", ("abc",), "13"), (S, "in", ("abc", "x"), "2"), (S, "not_in", ("abc",), "13"),
    (S, "contains", ("%",), "1"), (S, "not_contains", ("%",), "23"), (S, "contains", ("b_c",), ""), (S, ">", ("ab%c",), "2"),
    (S, "is_null", (), "3"), (S, "is_not_null", (), "12"), (D, ">=", (9.0,), "3"), (D, "<>", (5.0,), "23"),
    (D, "not_in", (5.0, 1.0), "23"), (D, "<", (9.0,), "1"), (N, "=", (7,), "1"), (N, "is_null", (), "23"),
    (FLAG, "true", (), "1"), (FLAG, "false", (), "2"), (B, "true", (), "1"), (B, "false", (), "23"),
])
def test_operators(rows, attribute, op, values, want):
    got = rows.where(compile_conditions(Conditions((Condition(attribute, op, values),)))).collect()
    assert "".join(sorted(r["id"] for r in got)) == want


def test_and_or_and_unknown(rows):
    pair = (Condition(S, "=", ("abc",)), Condition(D, ">", (8.0,)))
    assert rows.where(compile_conditions(Conditions(pair, "or"))).count() == 2
    assert rows.where(compile_conditions(Conditions(pair, "and"))).count() == 0
    assert rows.where(compile_conditions(None)).count() == 3
    with pytest.raises(ValueError):
        compile_conditions(Conditions((Condition(D, "contains", ("1",)),)))


def test_day_bounds_follow_daylight_saving():
    lo, hi = tu.day_bounds(dt.date(2024, 3, 10), dt.date(2024, 3, 10), "America/New_York")
    assert (hi - lo) == dt.timedelta(hours=23)
    assert lo.astimezone(UTC) == dt.datetime(2024, 3, 10, 5, tzinfo=UTC)


@pytest.mark.parametrize("n,unit,want", [
    (1, "DD", "2024-03-31"), (3, "DD", "2024-03-29"), (1, "WK", "2024-03-25"), (2, "WK", "2024-03-18"),
    (2, "MM", "2024-02-01"), (1, "YY", "2024-01-01"), (2, "YY", "2023-01-01")])
def test_relative_start(n, unit, want):
    now = dt.datetime(2024, 3, 31, 12, tzinfo=UTC)
    assert tu.relative_start(now, "UTC", n, unit).date().isoformat() == want
    dates = tu.scope_dates(Scope.last(n, unit, now), "UTC")
    assert dates[0].isoformat() == want and dates[-1] == now.date()


def test_scope_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.timestamp_seconds(F.col("id") + 1_704_000_000).alias("event_timestamp"), "id").write.parquet(path)
    df = spark.read.parquet(path).where(tu.in_scope(Scope.days("2024-01-01", "2024-01-02"), "Asia/Shanghai")).select("event_timestamp")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_timestamp,2023-12-31" in plan and "id" not in plan.split("ReadSchema")[1]


def test_whole_periods():
    day = dt.date
    assert tu.whole_periods(day(2024, 1, 10), day(2024, 1, 16), "WK") == (day(2024, 1, 8), day(2024, 1, 21))
    assert tu.whole_periods(day(2024, 1, 10), day(2024, 2, 16), "MM") == (day(2024, 1, 1), day(2024, 2, 29))
