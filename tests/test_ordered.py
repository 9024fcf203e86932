"""The chunked order operators give exactly what a plain window gives."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventloom.operators import ordered
from fixtures import frame, random_events

BACK, FORTH = F.desc, F.asc


@pytest.mark.parametrize("seed,chunk", [(1, 3600), (2, 600), (3, 86_400), (4, 7)])
def test_same_as_plain_windows(spark, seed, chunk):
    df = frame(spark, random_events(seed)).withColumn("t", F.unix_micros("event_timestamp")).withColumn(
        "v", F.when(F.col("event_name") == "a", F.col("event_value")))
    user = ["user_pseudo_id"]
    by = Window.partitionBy(*user)
    past = (Window.unboundedPreceding, -1)
    rows = by.orderBy(F.desc("event_timestamp"), F.desc("event_id")).rowsBetween(*past)
    later = by.orderBy(F.desc("t")).rangeBetween(*past)
    earlier = by.orderBy("t").rangeBetween(*past)
    upto = by.orderBy("event_timestamp", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    # Among equal clocks `first_after` may take any row, so its value is the clock itself.
    clock = F.when(F.col("event_name") == "a", F.col("t"))
    got = ordered.next_value(df, user, "event_timestamp", ["event_id"], F.col("v"), "n", chunk)
    got = ordered.first_after(got, user, "t", clock, "f", chunk)
    got = ordered.greatest_before(got, user, "t", F.col("v"), "g", chunk)
    got = ordered.running_sum(got, user, "event_timestamp", ["event_id"], F.col("event_value"), "s", chunk)
    want = df.select("event_id", F.last("v", True).over(rows).alias("n"), F.last(clock, True).over(later).alias("f"),
                     F.max("v").over(earlier).alias("g"), F.sum("event_value").over(upto).alias("s"))
    assert sorted(got.select("event_id", "n", "f", "g", "s").collect()) == sorted(want.collect())


def test_no_window_over_a_whole_user(spark):
    df = frame(spark, random_events(5))
    plan = ordered.running_sum(df, ["user_pseudo_id"], "event_timestamp", ["event_id"], F.col("event_value"), "s")
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    over_events = [w for w in lines if w.lstrip(" :+-").startswith("Window ") and "event_timestamp" in w]
    assert over_events and all("_chunk" in w for w in over_events)


def test_a_crowded_hour_is_cut_by_rows(spark):
    """One user with very many events in a minute: small chunks of about one size, and the same results."""
    from statistics import median

    burst = spark.range(40_000).select(F.lit("hot").alias("user_pseudo_id"), F.concat(F.lit("h"), "id").alias("event_id"),
                                       F.timestamp_micros(F.lit(1_704_067_200_000_000) + (F.col("id") * 7919 % 40_000) * 1500).alias("event_timestamp"),
                                       (F.col("id") % 11).cast("double").alias("event_value"))
    calm = spark.range(500).select(F.concat(F.lit("u"), F.col("id") % 9).alias("user_pseudo_id"), F.concat(F.lit("c"), "id").alias("event_id"),
                                   F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 60_000_000).alias("event_timestamp"),
                                   (F.col("id") % 5).cast("double").alias("event_value"))
    df = burst.unionByName(calm).withColumn("t", F.unix_micros("event_timestamp")).withColumn("v", F.when(F.col("event_value") > 8, F.col("event_value")))
    user = ["user_pseudo_id"]
    borders = ordered.crowded(df, user, "event_timestamp", limit=5000)
    assert ordered.crowded(df, user, "t", limit=50_000) is None and borders.rows.count() == 1
    sizes = [r["count"] for r in ordered._chunked(df.where("user_pseudo_id = 'hot'"), "t", F.lit(1), 3600, borders).groupBy("_chunk").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 3 * median(sizes)
    clock = F.when(F.col("v").isNotNull(), F.col("t"))

    def all_four(cut):
        got = ordered.next_value(df, user, "event_timestamp", ["event_id"], F.col("v"), "n", borders=cut)
        got = ordered.first_after(got, user, "t", clock, "f", borders=cut)
        got = ordered.greatest_before(got, user, "t", F.col("v"), "g", borders=cut)
        return sorted(ordered.running_sum(got, user, "event_timestamp", ["event_id"], F.col("event_value"), "s", borders=cut).select(
            "event_id", "n", "f", "g", "s").collect(), key=lambda r: r.event_id)

    assert all_four(borders) == all_four(None)
