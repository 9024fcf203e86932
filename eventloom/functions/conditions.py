"""Conditions on event and user properties as Column predicates."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.operators.explore.model import (
    BOOLEAN, DOUBLE, EVENT, FLOAT, INTEGER, NUMBER, STRING, USER, Attribute, Condition, Conditions,
)

# Value type -> Spark type. Fixed values.
TYPES = {STRING: "string", INTEGER: "bigint", DOUBLE: "double", FLOAT: "double", NUMBER: "double",
         BOOLEAN: "boolean"}
COMPARE = {"=": operator.eq, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def property_column(attribute: Attribute) -> Column:
    """The property's value in its type; a value that does not parse is null."""
    target = TYPES[attribute.data_type]
    if attribute.category == EVENT:
        return F.col("custom_parameters")[attribute.name]["value"].try_cast(target)
    if attribute.category == USER:
        return F.col("user_properties")[attribute.name]["value"].try_cast(target)
    # Flat booleans are kept as the text true or false.
    return F.col(attribute.name).try_cast("string" if attribute.data_type == BOOLEAN else target)


def _boolean(c: Column, cond: Condition) -> Column:
    flag = cond.operator == "true"
    if cond.attribute.category not in (EVENT, USER):
        return c == F.lit("true" if flag else "false")
    return c if flag else (c.isNull() | ~c)


def compile_one(cond: Condition) -> Column:
    """Negative conditions keep rows without a value."""
    c, op, values = property_column(cond.attribute), cond.operator, list(cond.values)
    if op == "is_null":
        return c.isNull()
    if op == "is_not_null":
        return c.isNotNull()
    if cond.attribute.data_type == BOOLEAN:
        return _boolean(c, cond)
    if op in COMPARE:
        return COMPARE[op](c, F.lit(values[0]))
    if op == "<>":
        return c.isNull() | (c != F.lit(values[0]))
    if op == "in":
        return c.isin(values)
    if op == "not_in":
        return c.isNull() | ~c.isin(values)
    if cond.attribute.data_type == STRING and op == "contains":
        return c.contains(values[0])
    if cond.attribute.data_type == STRING and op == "not_contains":
        return c.isNull() | ~c.contains(values[0])
    raise ValueError(f"operator {op} is not known for type {cond.attribute.data_type}")


def compile_conditions(conditions: Conditions | None) -> Column:
    if conditions is None or not conditions.items:
        return F.lit(True)
    join = operator.or_ if conditions.operator == "or" else operator.and_
    # A comparison with a missing value selects nothing.
    parts = [F.coalesce(compile_one(c), F.lit(False)) for c in conditions.items]
    return functools.reduce(join, parts)
