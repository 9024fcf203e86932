"""Removing repeated rows by key: one aggregate with a partial step, no window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hashable(name: str, kind: T.DataType) -> Column | None:
    """A column as a hash function takes it: maps as their entries; None for what holds a map further inside, or a variant."""
    text = kind.simpleString()
    if "variant" in text:
        return None
    if isinstance(kind, T.MapType):
        return F.map_entries(F.col(f"`{name}`")) if "map<" not in text[1:] else F.to_json(F.col(f"`{name}`"))
    return F.col(f"`{name}`") if "map<" not in text else F.to_json(F.col(f"`{name}`"))


def last_order(df: DataFrame, columns: list[str]) -> Column:
    """A last key of an order: a hash over all of the row's values, maps and arrays among them."""
    parts = [_hashable(f.name, f.dataType) for f in df.schema.fields if f.name in columns]
    parts = [c for c in parts if c is not None]
    return F.xxhash64(*parts) if parts else F.lit(0)


def keep_one(df: DataFrame, keys: list[str], order: list[str | Column], latest: bool = True) -> DataFrame:
    """The latest (or earliest) row per key under `order`.

    `max_by`/`min_by` combine before the shuffle, so a key with very many copies
    travels as one row per map task. Equal clocks are told apart by the row's own
    values, so a task that runs again picks the same row.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    chosen = pick(F.struct(*rest), F.struct(*order, last_order(df, rest))).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*[c if c in keys else f"_row.{c}" for c in df.columns])


def dedupe_events(events: DataFrame) -> DataFrame:
    """Latest created row per (event id, event time)."""
    return keep_one(events, ["event_id", "event_timestamp"], ["created_time"])


def dedupe_items(items: DataFrame) -> DataFrame:
    return keep_one(items, ["user_pseudo_id", "event_id", "item_id", "event_timestamp"], ["created_time"])


def dedupe_users(users: DataFrame, order: str = "event_timestamp") -> DataFrame:
    return keep_one(users, ["user_pseudo_id"], [order])
