"""Session rows: extraction from events, and the merge into a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.dedupe import last_order
from eventloom.names import DIRECT, SESSION_EVENTS, TRAFFIC_FIELDS

KEYS = ["app_id", "user_pseudo_id", "session_id"]


def _session_field(field: str) -> str:
    return "session_source_category" if field == "category" else f"session_{field}"


SOURCE_FIELDS = [_session_field(f) for f in TRAFFIC_FIELDS]


def extract_sessions(events: DataFrame) -> DataFrame:
    """One row per session: the earliest event with a real traffic source, else the earliest.

    The ordering puts events with a source other than Direct first, so a single
    aggregation (partial on the map side) answers both cases.
    """
    rank = F.when(F.coalesce(F.col("traffic_source_source") != DIRECT, F.lit(False)), 0).otherwise(1)
    has = set(events.columns)
    carried = [F.col(c) for c in ["event_timestamp", "user_id", "session_number", "session_start_time_msec"]
               if c in has]
    carried += [F.col(f"traffic_source_{f}").alias(_session_field(f)) for f in TRAFFIC_FIELDS]
    if "created_time" in has:
        carried.append(F.col("created_time"))
    if "process_info" in has:
        carried.append(
            F.map_concat(F.coalesce("process_info", F.create_map().cast("map<string,string>")),
                         F.create_map(F.lit("event_name"), F.col("event_name"))).alias("process_info"))
    picked = F.min_by(F.struct(*carried), F.struct(rank, F.col("event_timestamp"), F.col("event_id")))
    return (
        events.where(F.col("session_id").isNotNull() & F.col("event_name").isin(SESSION_EVENTS))
        .groupBy(*KEYS).agg(picked.alias("s")).select(*KEYS, "s.*")
    )


def best_in_batch(batch: DataFrame) -> DataFrame:
    """One row per session of a batch: a real source first, then Direct, then none."""
    source = F.col("session_source")
    rank = F.when(source.isNull(), 2).when(source == DIRECT, 1).otherwise(0)
    rest = [c for c in batch.columns if c not in KEYS]
    return (
        batch.groupBy(*KEYS)
        .agg(F.min_by(F.struct(*rest), F.struct(
            rank, F.col("created_time"), F.col("event_timestamp"), last_order(batch, rest))).alias("s"))
        .select(*KEYS, "s.*")
    )


def merge_sessions(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored sessions after a batch; a row is replaced as a whole or kept as a whole.

    A stored row gives way when it has no source, or when its source is Direct
    and the batch brings one.
    """
    rest = [c for c in target.columns if c not in KEYS]
    new = best_in_batch(batch).select(*KEYS, F.struct(*rest).alias("n"))
    old = target.select(*KEYS, F.struct(*rest).alias("o"))
    stored = F.col("o.session_source")
    take_new = F.col("o").isNull() | (
        F.col("n").isNotNull()
        & (stored.isNull() | ((stored == DIRECT) & F.col("n.session_source").isNotNull()))
    )
    kept = F.when(take_new, F.col("n")).otherwise(F.col("o")).alias("row")
    return old.join(new, KEYS, "full_outer").select(*KEYS, kept).select(*KEYS, "row.*")


def fold_batches(rows: DataFrame) -> DataFrame:
    """What `merge_sessions` leaves after all batches in order, from their rows (one per session and `batch`) at once.

    The first real source stays for good; without one the last Direct row stands, without that the last row.
    """
    source = F.col("session_source")
    rank = F.when(source.isNull(), 2).when(source == DIRECT, 1).otherwise(0)
    place = F.when(rank == 0, F.col("batch")).otherwise(-F.col("batch"))
    rest = [c for c in rows.columns if c not in KEYS]
    return rows.groupBy(*KEYS).agg(F.min_by(F.struct(*rest), F.struct(rank, place)).alias("s")).select(*KEYS, "s.*")
