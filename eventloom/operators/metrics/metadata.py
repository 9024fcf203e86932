"""Catalogue of events, event properties and user attributes with their most frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEPARATOR = "#|!|#"
# Properties of which more values are usually shown, for `limits`. Fixed values.
WIDE_LIMITS = {"page_view_page_title": 50, "page_view_page_url": 50, "screen_view_screen_name": 50, "screen_view_screen_id": 50}


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.concat(F.lit("#"), F.date_format("event_timestamp", "yyyyMM"))).withColumn(
        "day_number", F.dayofmonth("event_timestamp"))


def _joined(name: str):
    return F.array_join(F.array_sort(F.collect_set(name)), SEPARATOR)


def event_parameters(events: DataFrame, presets: dict[str, tuple[str, str]], limit: int = 20,
                     limits: dict[str, int] | None = None) -> DataFrame:
    """The `limit` most frequent values per day, platform, event and property; `limits` names properties with another limit.

    Values are counted whole, however long.

    `presets` maps a column to its (category, value type); custom parameters come
    from the map column. One scan unpivots all of them; counting combines on the
    map side, and the top-n filter is planned as a group limit that prunes before
    its shuffle as well as after.
    """
    entry = lambda cat, name, value, kind, event: F.struct(
        F.lit(cat).alias("category"), name.alias("property_name"),
        value.cast("string").alias("property_value"),
        kind.alias("value_type"), event.alias("event_name"))
    fixed = F.array(*[entry(cat, F.lit(c), F.col(c), F.lit(kind), F.lit("")) for c, (cat, kind) in presets.items()])
    custom = F.transform(
        F.map_entries("custom_parameters"),
        lambda e: entry("event", e["key"], e["value"]["value"], e["value"]["type"], F.col("event_name")))
    entries = F.concat(fixed, F.coalesce(custom, F.array().cast(
        "array<struct<category:string,property_name:string,property_value:string,value_type:string,event_name:string>>")))
    counts = (
        _day(events).select("app_id", "month", "day_number", "platform", F.explode(entries).alias("p"))
        .select("app_id", "month", "day_number", "platform", "p.*")
        .where(F.col("property_value").isNotNull() & (F.col("property_value") != ""))
        .groupBy("app_id", "category", "month", "day_number", "property_name", "property_value",
                 "value_type", "platform", "event_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(
        Window.partitionBy("app_id", "category", "month", "day_number", "value_type", "property_name",
                           "platform", "event_name").orderBy(F.desc("n"), "property_value"))
    limits = limits or {}
    top = counts.withColumn("_rank", rank).where(F.col("_rank") <= max([limit, *limits.values()]))
    allowed = F.lit(limit)
    for name, n in limits.items():
        allowed = F.when(F.col("property_name") == name, n).otherwise(allowed)
    top = top.where(F.col("_rank") <= allowed)
    return top.groupBy("app_id", "category", "month", "day_number", "property_name", "property_value",
                       "value_type").agg(
        F.sum("n").alias("count"), _joined("platform").alias("platform"),
        _joined("event_name").alias("event_name_set"))


def user_attributes(users: DataFrame, limit: int = 20) -> DataFrame:
    """`value_count` lists per user attribute, from (property_name, property_value, value_type) rows."""
    counts = (
        users.where(~F.col("property_name").contains("timestamp")
                    & F.col("property_value").isNotNull() & (F.col("property_value") != ""))
        .groupBy("category", "property_name", "property_value", "value_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(
        Window.partitionBy("category", "property_name", "value_type").orderBy(F.desc("n"), "property_value"))
    labelled = F.transform(
        F.array_sort(F.collect_list(F.struct("property_value", "n"))),
        lambda e: F.concat(e["property_value"], F.lit("_"), e["n"].cast("string")))
    return (
        counts.withColumn("_rank", rank).where(F.col("_rank") <= limit)
        .groupBy("category", "property_name", "value_type")
        .agg(F.array_join(labelled, SEPARATOR).alias("value_enum"))
    )


def user_attribute_rows(users: DataFrame, columns: list[str]) -> DataFrame:
    """Unpivots outer user columns and the property map (when present) to one row per attribute."""
    outer = [F.struct(F.lit("user_outer").alias("category"), F.lit(c).alias("property_name"),
                      F.col(c).cast("string").alias("property_value"),
                      F.lit("string").alias("value_type")) for c in columns]
    entries = F.array(*outer)
    if "user_properties" in users.columns:
        entries = F.concat(entries, F.coalesce(F.transform(
            F.map_entries("user_properties"),
            lambda e: F.struct(F.lit("user").alias("category"), e["key"].alias("property_name"),
                               e["value"]["value"].alias("property_value"),
                               e["value"]["type"].alias("value_type"))), F.array_repeat(outer[0], 0)))
    return users.select(F.explode(entries).alias("p")).select("p.*")


def event_catalogue(events: DataFrame) -> DataFrame:
    return (
        _day(events.where("event_name != '_'")).groupBy("app_id", "event_name", "month", "day_number").agg(
            F.count(F.lit(1)).alias("count"), _joined("platform").alias("platform"),
            _joined("sdk_version").alias("sdk_version"), _joined("sdk_name").alias("sdk_name"))
    )
