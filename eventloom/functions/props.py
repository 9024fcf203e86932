"""Free-form JSON objects as typed property maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.let import let

EVENT_MAP = "map<string,struct<value:string,type:string>>"
USER_MAP = "map<string,struct<value:string,type:string,set_time_msec:bigint>>"


def _type(kind: Column) -> Column:
    """Type tag of a variant's schema text: string, number, boolean or object."""
    return (
        F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(_nested(kind), "object").otherwise("number"))


def _nested(kind: Column) -> Column:
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _text(v: Column, kind: Column) -> Column:
    return F.when(_nested(kind), F.to_json(v)).otherwise(v.try_cast("string"))


def value_text(v: Column) -> Column:
    return let(F.schema_of_variant(v), lambda kind: _text(v, kind))


def tagged(v: Column, *more: Column) -> Column:
    """struct<value,type,...> of a variant; its schema is looked at once."""
    return let(F.schema_of_variant(v), lambda kind: F.struct(
        _text(v, kind).alias("value"), _type(kind).alias("type"), *more))


def variant_map(json: Column) -> Column:
    """Top-level members of a JSON object; null when the text is no object."""
    return F.from_json(json, "map<string,variant>")


def typed(members: Column) -> Column:
    """map<string,variant> -> map<string,struct<value,type>>."""
    return F.transform_values(members, lambda k, v: tagged(v))


def without(members: Column, names: list[str]) -> Column:
    return F.map_filter(members, lambda k, v: ~k.isin(names))


def merge(left: Column, right: Column) -> Column:
    """Right wins; a missing side counts as empty."""
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(F.map_concat(left, right))
