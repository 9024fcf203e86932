"""From uploads to clean events: decode, explode, parse, reject, filter."""

from __future__ import annotations

import base64
import gzip
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.names import FIRST_OPEN, FIRST_VISIT, PROFILE_SET

# An event as sent by the SDK; user, attributes and items stay text. Fixed values.
EVENT_SCHEMA = (
    "_corrupt_record string, app_id string, unique_id string, device_id string, device_unique_id string, "
    "event_type string, event_id string, timestamp bigint, platform string, os_version string, make string, "
    "brand string, model string, carrier string, network_type string, screen_height bigint, screen_width bigint, "
    "zone_offset bigint, locale string, system_language string, host_name string, app_version string, "
    "app_package_name string, app_title string, user string, attributes string, event_value double, "
    "event_value_currency string, event_previous_timestamp bigint, viewport_width bigint, viewport_height bigint, "
    "items string, sdk_version string, sdk_name string"
)
EVENT_FIELDS = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]


def _gunzip_udf():
    """Built inside a function so that the code travels with the job to the executors."""
    def unpack(text):
        if text is None:
            return None
        try:
            return gzip.decompress(base64.b64decode(text)).decode("utf-8")
        except (OSError, EOFError, ValueError, zlib.error) as e:
            return f"error: {e}"

    def gunzip(texts: pd.Series) -> pd.Series:
        return texts.map(unpack)

    return F.pandas_udf(gunzip, T.StringType())


# base64(gzip(text)) -> text; the one step Spark has no function for.
gunzip_base64 = _gunzip_udf()


def strip(c: Column) -> Column:
    """Without white space at either end, line breaks included."""
    return F.trim(c, F.lit(" \t\r\n"))


def decode_payload(data: Column) -> Column:
    """JSON arrays pass through; anything else is unpacked; what fails becomes an error entry."""
    plain = strip(data)
    is_array = F.coalesce(plain.startswith("[") & plain.endswith("]"), F.lit(False))
    packed = gunzip_base64(F.when(is_array, F.lit(None)).otherwise(data))
    failed = F.to_json(F.array(F.concat(packed, F.lit(", inputData: "), data)))
    return (
        F.when(data.isNull(), F.lit('["error: data is null"]')).when(is_array, plain)
        .when(packed.startswith("error: "), failed).otherwise(packed))


def entries_of(data: Column) -> Column:
    """The upload's events as texts; an array that does not parse is one entry, to be rejected with its text."""
    return F.coalesce(F.from_json(decode_payload(data), "array<string>"), F.array(data))


def explode_events(uploads: DataFrame) -> DataFrame:
    """One row per element of the upload's JSON array, with its position."""
    rest = [c for c in uploads.columns if c != "data"]
    return uploads.select(*rest, F.posexplode(entries_of(F.col("data"))).alias("position", "data"))


def parse_elements(rows: DataFrame, elements: Column, schema: str, name: str, options: dict | None = None) -> DataFrame:
    """One row per element with its position, text and parsed struct.

    The parsing is part of the generator, so filters on the struct stay above it:
    as a plain column it would be repeated in every pushed-down condition.
    """
    rest = [c for c in rows.columns if c != "data"]
    both = F.transform(elements, lambda x: F.struct(x.alias("data"), F.from_json(x, schema, options).alias(name)))
    return rows.select(*rest, F.posexplode(both).alias("position", "_x")).select(
        *rest, "position", "_x.data", F.col(f"_x.{name}").alias(name))


def parse_uploads(uploads: DataFrame) -> DataFrame:
    """One row per sent event with its struct `e`; broken JSON sets its corrupt-record field."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return parse_elements(uploads, entries_of(F.col("data")), EVENT_SCHEMA, "e", options)


def reject_reason() -> Column:
    """Why an entry is unusable, or null."""
    return (
        F.when(F.col("e").isNull() | F.col("e._corrupt_record").isNotNull(), "corrupt")
        .when(F.col("e.event_id").isNull(), "event_id").when(F.col("e.app_id").isNull(), "app_id")
        .when(F.col("e.timestamp").isNull(), "timestamp"))


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable entries, rejected entries with a reason)."""
    marked = parsed.withColumn("reason", reject_reason())
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def fresh(events: DataFrame, now_msec: int | Column, hours: int = 72) -> DataFrame:
    """Drops future events and those older than `hours` at ingest; three event names always pass."""
    now = F.lit(now_msec) if isinstance(now_msec, int) else now_msec
    at = F.col("e.timestamp")
    always = F.coalesce(F.col("e.event_type").isin(FIRST_OPEN, FIRST_VISIT, PROFILE_SET), F.lit(False))
    return events.where(always | ((at <= now) & (F.col("ingest_time") - at <= hours * 3_600_000)))


def filter_apps(events: DataFrame, app_ids: list[str]) -> DataFrame:
    return events.where(F.col("e.app_id").isin(app_ids))


def drop_bots(events: DataFrame, enabled: bool = True) -> DataFrame:
    """Keeps rows whose device category is unknown."""
    category = F.col("device_ua_device_category")
    return events.where(category.isNull() | (category != "Bot")) if enabled else events


def clean(uploads: DataFrame, app_ids: list[str], now_msec: int | Column, hours: int = 72) -> tuple[DataFrame, DataFrame]:
    """Usable, fresh events of the given apps; and the rejects."""
    good, bad = split_corrupt(parse_uploads(uploads))
    return filter_apps(fresh(good, now_msec, hours), app_ids), bad
