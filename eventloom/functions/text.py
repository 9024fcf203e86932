"""Byte-length limits on text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cut_bytes(c: Column, limit: int) -> Column:
    """The longest prefix within `limit` characters that fits into `limit` UTF-8 bytes.

    Only values that are too long do any work. A prefix of n characters fits when
    its bytes do, and bytes grow with n, so the cut is the number of characters
    whose running byte count stays within the limit: counted in one pass.
    """
    head = F.substring(c, 1, limit)
    chars = F.split(head, "")
    fit = F.aggregate(
        chars, F.struct(F.lit(0).alias("bytes"), F.lit(0).alias("n")),
        lambda acc, ch: F.struct(
            (acc["bytes"] + F.octet_length(ch)).alias("bytes"),
            F.when(acc["bytes"] + F.octet_length(ch) <= limit, acc["n"] + 1).otherwise(acc["n"]).alias("n")))
    cut = F.when(F.octet_length(head) <= limit, head).otherwise(F.substring(head, F.lit(1), fit["n"]))
    return F.when(F.octet_length(c) > limit, cut).otherwise(c)


def max_bytes(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Truncates columns; `<column>_truncated` tells which rows were cut."""
    marks = {f"{c}_truncated": F.coalesce(F.octet_length(c) > n, F.lit(False)) for c, n in limits.items()}
    return df.withColumns(marks).withColumns({c: cut_bytes(F.col(c), n) for c, n in limits.items()})


def spread_nulls(df: DataFrame, column: str, by: str = "event_id") -> Column:
    """A text column as join key: rows without a value get keys that match nothing, many instead of one."""
    spread = F.xxhash64(by) % 4096 if by in df.columns else F.lit(0)
    return F.when(F.coalesce(F.col(column), F.lit("")) != "", F.col(column)).otherwise(
        F.concat(F.lit("\x00"), spread.cast("string")))


def too_long(limits: dict[str, int]) -> Column:
    """Rows that would lose something to the limits."""
    hit = F.lit(False)
    for c, n in limits.items():
        hit = hit | F.coalesce(F.octet_length(c) > n, F.lit(False))
    return hit
