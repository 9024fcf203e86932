"""Which touch points led to a conversion, and how much each one earned.

A touch belongs to the user's next conversion. "Next" is found over time chunks
(operators.ordered), so one user may hold any share of the rows. The models need
only, per conversion and touch label, the number of touches and the first and
last of them: a partial aggregate, followed by windows over the few labels of one
conversion.
"""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.conditions import property_column
from eventloom.functions.timeunits import day_bounds, instant, local_date, relative_start
from eventloom.operators.explore.base import base_data, chosen_events, step_condition
from eventloom.operators.explore.model import AttributionQuery, SUM_VALUE
from eventloom.operators.ordered import crowded, next_value, running_sum
from eventloom.session import staged

CONVERSION = ["user_pseudo_id", "conversion_id", "conversion_time"]


def _base(view: DataFrame, q: AttributionQuery) -> DataFrame:
    """Events by device user; the scan starts earlier by the look-back window."""
    names = list(dict.fromkeys([*[t.event_name for t in q.touches], q.target.event_name]))
    if q.window_seconds:
        q = dataclasses.replace(q, scope=dataclasses.replace(q.scope, look_back_seconds=q.window_seconds))
    return base_data(view, q, chosen_events(names), merged=False)


def _scope_start(q: AttributionQuery) -> Column:
    if q.scope.kind == "FIXED":
        return instant(day_bounds(q.scope.start, q.scope.end, q.tz)[0])
    return instant(relative_start(q.scope.now, q.tz, q.scope.last_n, q.scope.unit))


def _labelled(view: DataFrame, q: AttributionQuery) -> DataFrame:
    """One row per conversion (label null) and per (event, matching touch point)."""
    hits = [F.when(step_condition(t), F.struct(F.lit(f"{i + 1}_{t.event_name}").alias("label")))
            for i, t in enumerate(q.touches)]
    target = F.when(step_condition(q.target), F.struct(F.lit(None).cast("string").alias("label")))
    value = property_column(q.value).cast("double") if q.method == SUM_VALUE and q.value else F.lit(0.0)
    return (
        _base(view, q).withColumn("_hit", F.explode(F.array_compact(F.array(*hits, target))))
        .select("user_pseudo_id", "session_id", "event_id", "event_timestamp",
                F.col("_hit.label").alias("label"), F.when(F.col("_hit.label").isNull(), value).alias("sum_value"))
        .withColumn("is_target", F.when(F.col("label").isNull(), 1).otherwise(0))
    )


def touches(view: DataFrame, q: AttributionQuery) -> DataFrame:
    """Touch points with the conversion they count for."""
    return _touches(staged(_labelled(view, q), "labelled"), q)


def _touches(rows: DataFrame, q: AttributionQuery) -> DataFrame:
    conversion = F.when(F.col("is_target") == 1, F.struct(
        F.col("event_id").alias("conversion_id"), F.col("event_timestamp").alias("conversion_time"),
        F.col("session_id").alias("conversion_session"), "sum_value"))
    # A touch at the very event of a conversion sorts before it and counts for it.
    borders = crowded(rows, ["user_pseudo_id"], "event_timestamp")
    ahead = next_value(rows, ["user_pseudo_id"], "event_timestamp", ["event_id", "is_target"], conversion, "_c", borders=borders)
    joined = ahead.where((F.col("is_target") == 0) & F.col("_c").isNotNull()).select(
        "user_pseudo_id", "session_id", "event_id", "event_timestamp", "label", "_c.*")
    if q.window == "SESSION":
        keep = F.col("conversion_session") == F.col("session_id")
    elif q.window == "CURRENT_DAY":
        # The day test compared the conversion with itself; compat keeps it always true.
        keep = (F.lit(True) if q.compat else
                local_date("conversion_time", q.tz) == local_date("event_timestamp", q.tz))
    else:
        gap = F.unix_micros("conversion_time") - F.unix_micros("event_timestamp")
        keep = gap <= (q.window_seconds or 0) * 1_000_000
    return joined.where(keep & (F.col("conversion_time") >= _scope_start(q)))


def attribution_base(view: DataFrame, q: AttributionQuery) -> DataFrame:
    """Touches with their position before the conversion, counted from the first one."""
    return running_sum(touches(view, q), CONVERSION, "event_timestamp", ["event_id", "label"],
                       F.lit(1), "row_seq").drop("sum_value")


def _earned(q: AttributionQuery) -> Column:
    """Share of the conversion a label earns, from counts per (conversion, label)."""
    whole = Window.partitionBy(*CONVERSION)
    n, total = F.col("n"), F.sum("n").over(whole)
    is_first = F.when(F.col("first_at") == F.min("first_at").over(whole), 1).otherwise(0)
    is_last = F.when(F.col("last_at") == F.max("last_at").over(whole), 1).otherwise(0)
    if q.model == "LAST":
        return is_last.cast("double")
    if q.model == "FIRST":
        return is_first.cast("double")
    if q.model == "LINEAR":
        return n / total
    if q.model == "POSITION":
        w_first, w_middle, w_last = q.weights
        # The middle weight is divided by all touches of the conversion, not by the middle ones.
        spread = (is_first * w_first + is_last * w_last + (n - is_first - is_last) * (F.lit(w_middle) / total))
        return F.when(total == 1, F.lit(1.0)).when(total == 2, n * 0.5).otherwise(spread)
    raise ValueError(f"attribution model {q.model} is not known")


def attribution(view: DataFrame, q: AttributionQuery) -> DataFrame:
    """Per touch point: triggers, conversions, triggers that led to one, contribution and its share."""
    at = F.struct("event_timestamp", "event_id", "label")
    labelled = staged(_labelled(view, q), "labelled")
    per_label = _touches(labelled, q).groupBy(*CONVERSION, "label").agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        F.max("sum_value").alias("sum_value"))
    earned = per_label.withColumn("earned", _earned(q))
    if q.method == SUM_VALUE:
        earned = earned.withColumn("earned", F.col("earned") * F.col("sum_value"))
    single = q.model in ("LAST", "FIRST")
    chosen = (F.count_if(F.col("_share") > 0) if single else F.count(F.lit(1))).alias("_rows")
    shares = earned.withColumn("_share", _earned_flag(q)).groupBy("label").agg(
        F.sum("earned").alias("contribution"), F.sum("n").alias("triggers_with_conversion"), chosen
    ).where("_rows > 0").drop("_rows")
    shares = staged(shares, "shares")  # one row per touch point, read for the total too
    triggers = labelled.groupBy("label").agg(F.count("event_id").alias("trigger_count"))
    conversions = triggers.where(F.col("label").isNull()).select("trigger_count").scalar()
    total = shares.select(F.sum("contribution")).scalar()
    shown = functools.reduce(
        lambda acc, pair: F.when(F.col("label") == pair[0], F.lit(pair[1])).otherwise(acc),
        zip([f"{i + 1}_{t.event_name}" for i, t in enumerate(q.touches)], _names(q)), F.col("label"))
    return shares.join(triggers, "label").select(
        "trigger_count", shown.alias("touch_point_name"), conversions.alias("total_conversions"),
        "triggers_with_conversion", "contribution",
        (F.col("contribution") / F.nullif(total, F.lit(0.0))).alias("contribution_rate"))


def _earned_flag(q: AttributionQuery) -> Column:
    """Whether a label holds the single touch of the LAST or FIRST model."""
    whole = Window.partitionBy(*CONVERSION)
    if q.model == "FIRST":
        return F.when(F.col("first_at") == F.min("first_at").over(whole), 1).otherwise(0)
    return F.when(F.col("last_at") == F.max("last_at").over(whole), 1).otherwise(0)


def _names(q: AttributionQuery) -> list[str]:
    given = list(q.touch_names) + [""] * len(q.touches)
    return [given[i] or f"{i + 1}_{t.event_name}" for i, t in enumerate(q.touches)]
