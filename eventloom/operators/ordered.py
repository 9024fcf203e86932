"""Order-dependent values over keys of any size.

A window over a user puts the whole user into one task. Here a key is cut into
time chunks: the window runs per (key, chunk), and what crosses a chunk border
comes from a summary with one row per (key, chunk), whose size depends on the time
range and not on the number of events. A chunk that holds too many rows of a key
(`crowded`) is cut again, at times between which about as many rows lie. Results are
exactly those of the plain window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import staged

CHUNK_SECONDS = 3600
# Rows of a key in one chunk beyond which it is cut into so many pieces.
CHUNK_ROWS, PIECES = 100_000, 256
PAST = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Borders:
    """(on, _hour, _borders): the inner borders, in microseconds, of the chunks that hold too many rows."""

    rows: DataFrame
    on: list[str]


def _micros(df: DataFrame, ts: str) -> Column:
    return F.col(ts) if dict(df.dtypes)[ts] == "bigint" else F.unix_micros(ts)


def _hour(df: DataFrame, ts: str, seconds: int) -> Column:
    return F.floor(_micros(df, ts) / 1_000_000 / seconds)


def crowded(df: DataFrame, on: list[str], ts: str, seconds: int = CHUNK_SECONDS, limit: int = CHUNK_ROWS) -> Borders | None:
    """Borders for the chunks of `df` (stored rows) with more than `limit` rows of a key; None if there are none.

    One count per (key, chunk), combined before the shuffle; only crowded chunks are read again for the quantiles of their times.
    """
    timed = df.select(*on, _hour(df, ts, seconds).alias("_hour"), _micros(df, ts).alias("_at")).dropna(subset=on)
    hot = staged(timed.groupBy(*on, "_hour").count().where(F.col("count") > limit).drop("count"), "crowded")
    if hot.isEmpty():
        return None
    cuts = [k / PIECES for k in range(1, PIECES)]
    borders = timed.join(hot, [*on, "_hour"]).groupBy(*on, "_hour").agg(
        F.array_distinct(F.percentile_approx("_at", cuts, 20 * PIECES)).alias("_borders"))
    return Borders(staged(borders, "borders"), on)


def _chunked(df: DataFrame, ts: str, value: Column, seconds: int, borders: Borders | None = None) -> DataFrame:
    """Rows of equal time are in one chunk, and chunks are numbered in the order of time."""
    rows = df.withColumn("_hour", _hour(df, ts, seconds)).withColumn("_value", value)
    if borders is None:
        return rows.withColumnRenamed("_hour", "_chunk")
    at = _micros(df, ts)
    piece = F.coalesce(F.size(F.filter("_borders", lambda b: b <= at)), F.lit(0))
    return rows.join(borders.rows, [*borders.on, "_hour"], "left").withColumn(
        "_chunk", F.col("_hour") * PIECES + piece).drop("_hour", "_borders").select(*df.columns, "_value", "_chunk")


def _with_carry(rows: DataFrame, keys: list[str], inside: Column, summary: Column, fold, backwards: bool) -> DataFrame:
    """Adds `_near` (from the row's own chunk) and `_far` (folded over the chunks beyond it)."""
    order = F.desc("_chunk") if backwards else F.asc("_chunk")
    beyond = Window.partitionBy(*keys).orderBy(order).rowsBetween(*PAST)
    far = rows.groupBy(*keys, "_chunk").agg(summary.alias("_sum")).withColumn("_far", fold("_sum").over(beyond))
    return rows.withColumn("_near", inside).join(far.drop("_sum"), [*keys, "_chunk"], "left")


def _finish(rows: DataFrame, out: str, value: Column) -> DataFrame:
    return rows.withColumn(out, value).drop("_chunk", "_value", "_near", "_far")


def _last(c):
    return F.last(c, ignorenulls=True)


def next_value(df: DataFrame, keys: list[str], ts: str, order: list[str], value: Column, out: str,
               seconds: int = CHUNK_SECONDS, borders: Borders | None = None) -> DataFrame:
    """Adds `out`: the first non-null `value` after each row in the order (ts, *order)."""
    rows = _chunked(df, ts, value, seconds, borders)
    # Rows run backwards so that the frame only grows; "last" is then the nearest row ahead.
    w = Window.partitionBy(*keys, "_chunk").orderBy(F.desc(ts), *[F.desc(c) for c in order]).rowsBetween(*PAST)
    head = F.min_by("_value", F.when(F.col("_value").isNotNull(), F.struct(ts, *order)))
    carried = _with_carry(rows, keys, _last("_value").over(w), head, _last, backwards=True)
    return _finish(carried, out, F.coalesce("_near", "_far"))


def first_after(df: DataFrame, keys: list[str], micros: str, value: Column, out: str,
                seconds: int = CHUNK_SECONDS, borders: Borders | None = None) -> DataFrame:
    """Adds `out`: the first non-null `value` at a strictly later time."""
    rows = _chunked(df, micros, value, seconds, borders)
    w = Window.partitionBy(*keys, "_chunk").orderBy(F.desc(micros)).rangeBetween(*PAST)
    head = F.min_by("_value", F.when(F.col("_value").isNotNull(), F.col(micros)))
    carried = _with_carry(rows, keys, _last("_value").over(w), head, _last, backwards=True)
    return _finish(carried, out, F.coalesce("_near", "_far"))


def greatest_before(df: DataFrame, keys: list[str], micros: str, value: Column, out: str,
                    seconds: int = CHUNK_SECONDS, borders: Borders | None = None) -> DataFrame:
    """Adds `out`: the greatest `value` at a strictly earlier time."""
    rows = _chunked(df, micros, value, seconds, borders)
    w = Window.partitionBy(*keys, "_chunk").orderBy(micros).rangeBetween(*PAST)
    carried = _with_carry(rows, keys, F.max("_value").over(w), F.max("_value"), F.max, backwards=False)
    return _finish(carried, out, F.greatest("_near", "_far"))


def running_sum(df: DataFrame, keys: list[str], ts: str, order: list[str], value: Column, out: str,
                seconds: int = CHUNK_SECONDS, borders: Borders | None = None) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the key up to and including each row."""
    rows = _chunked(df, ts, value, seconds, borders)
    w = (Window.partitionBy(*keys, "_chunk").orderBy(ts, *order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = _with_carry(rows, keys, F.sum("_value").over(w), F.sum("_value"), F.sum, backwards=False)
    return _finish(carried, out, F.col("_near") + F.coalesce("_far", F.lit(0)))
