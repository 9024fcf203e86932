"""Raw uploads as JSON lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The read schema of an upload. Fixed values.
RAW_SCHEMA = (
    "_corrupt_record string, date string, data string, ip string, source_type string, rid string, ua string, "
    "m string, uri string, platform string, path string, appId string, compression string, ingest_time bigint, "
    "client_timestamp string, server_ingest_time string, hour string"
)
PARTITIONS = ["year", "month", "day", "hour_of_day"]


def read_raw(spark: SparkSession, paths: str | list[str], start: dt.datetime | None = None,
             end: dt.datetime | None = None) -> DataFrame:
    """Uploads with their file name. Broken lines keep their text in `_corrupt_record`.

    `start` and `end` select files by modification time, [start, end + 1 second].
    """
    reader = spark.read.schema(RAW_SCHEMA).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", "true")
    stamp = lambda t: t.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    if start is not None:
        reader = reader.option("modifiedAfter", stamp(start - dt.timedelta(seconds=1)))
    if end is not None:
        reader = reader.option("modifiedBefore", stamp(end + dt.timedelta(seconds=1)))
    paths = [paths] if isinstance(paths, str) else paths
    return reader.json(paths).withColumn("input_file_name", F.col("_metadata.file_path"))


def read_partitions(spark: SparkSession, base: str, start: dt.date, end: dt.date) -> DataFrame:
    """Uploads of the days start..end; the folders are pruned by their partition columns."""
    rows = spark.read.schema(RAW_SCHEMA + ", year int, month int, day int, hour_of_day int").option(
        "mode", "PERMISSIVE").json(base)
    number = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    as_int = lambda d: d.year * 10_000 + d.month * 100 + d.day
    return rows.where(number.between(as_int(start), as_int(end)))


def write_raw(uploads: DataFrame, base: str) -> None:
    """Uploads into hour folders of their ingest time."""
    at = F.timestamp_millis("ingest_time")
    (uploads.withColumn("year", F.year(at)).withColumn("month", F.month(at)).withColumn("day", F.dayofmonth(at))
     .withColumn("hour_of_day", F.hour(at)).write.mode("append").partitionBy(*PARTITIONS).json(base))
