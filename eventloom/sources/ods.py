"""The stored tables: partitioned parquet by app and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eventloom.operators.dedupe import keep_one
from eventloom.operators.upsert import is_missing

PARTITIONS = ["partition_app", "partition_year", "partition_month", "partition_day"]
ROWS_PER_FILE = 50_000


def _day() -> Column:
    """The folder's day as a number; folder names keep leading zeros, inferred columns may not."""
    part = lambda p: F.col(p).cast("int")
    return part("partition_year") * 10_000 + part("partition_month") * 100 + part("partition_day")


def _as_number(d: dt.date) -> int:
    return d.year * 10_000 + d.month * 100 + d.day


def with_partitions(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return df.withColumns({
        "partition_app": F.col("app_id"), "partition_year": F.date_format(ts, "yyyy"),
        "partition_month": F.date_format(ts, "MM"), "partition_day": F.date_format(ts, "dd")})


def output_partitions(df: DataFrame) -> DataFrame:
    """How the output spreads: rows, folders, and files at the target size, in one aggregation."""
    folder = F.concat_ws("/", *PARTITIONS)
    return with_partitions(df).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(folder).alias("folders")).withColumn(
        "files", F.ceil(F.col("rows") / ROWS_PER_FILE) + F.col("folders"))


def write_ods(df: DataFrame, path: str, fmt: str = "parquet", ts: str = "event_timestamp") -> None:
    """Appends by folder. The rebalance hint gathers the rows of a folder, so that files are few,
    and lets the adaptive planner cut a folder with a large share of the rows into several tasks."""
    rows = with_partitions(df, ts).hint("rebalance", *PARTITIONS)
    writer = rows.write.mode("append").partitionBy(*PARTITIONS).option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.json(path) if fmt == "json" else writer.option("compression", "snappy").parquet(path)


def read_ods(spark: SparkSession, path: str, schema: T.StructType, start: dt.datetime | None = None,
             end: dt.datetime | None = None, ts: str = "event_timestamp") -> DataFrame:
    """Rows with start <= time < end. The day folders are pruned too; a missing path reads as empty."""
    folders = T.StructType([T.StructField(p, T.StringType()) for p in PARTITIONS if p not in schema.names])
    try:
        rows = spark.read.schema(T.StructType(schema.fields + folders.fields)).parquet(path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], schema)
    if start is not None:
        rows = rows.where((F.col(ts) >= F.lit(start)) & (_day() >= _as_number(start.date())))
    if end is not None:
        rows = rows.where((F.col(ts) < F.lit(end)) & (_day() <= _as_number(end.date())))
    return rows.drop(*PARTITIONS)


def ods_view(spark: SparkSession, path: str, app: str, since: dt.date) -> DataFrame:
    """Saved point query: one app from a date on, by partition columns only."""
    return spark.read.option("basePath", path).parquet(path).where(
        (F.col("partition_app") == app) & (_day() >= _as_number(since)))


def event_user_session(events: DataFrame, users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Saved query over the three tables; the latest row of a user and of a session counts."""
    u = keep_one(users, ["app_id", "user_pseudo_id"], ["event_timestamp"])
    s = keep_one(sessions, ["app_id", "user_pseudo_id", "session_id"], ["event_timestamp"])
    u = u.drop(*[c for c in u.columns if c in events.columns and c not in ("app_id", "user_pseudo_id")])
    s = s.drop(*[c for c in s.columns if c in events.columns and c not in ("app_id", "user_pseudo_id", "session_id")])
    return events.join(u, ["app_id", "user_pseudo_id"], "left").join(
        s, ["app_id", "user_pseudo_id", "session_id"], "left")


def write_rejects(rejects: DataFrame, path: str, job: str) -> None:
    """Rejected records as compressed JSON, by job."""
    cols = [c for c in rejects.columns if c not in ("e", "job_name")]
    rejects.select(*cols).withColumn("job_name", F.lit(job)).write.mode("append").partitionBy("job_name").option(
        "compression", "gzip").json(path)


def load_batch(spark: SparkSession, paths: list[str], keys: list[str], order: list[str], schema=None) -> DataFrame:
    """A batch of stored files as staging rows, one per key."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return keep_one(reader.parquet(*paths), keys, order)
