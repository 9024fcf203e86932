"""Keyed upserts, day refreshes and expiry over DataFrames and stored tables."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eventloom.operators.dedupe import keep_one
from eventloom.session import exists, staged

LEAST, GREATEST, ADD = "least", "greatest", "add"


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without a new version, and all source rows."""
    t, s = target.alias("t"), source.select(*keys).distinct().alias("s")
    on = functools.reduce(operator.and_, [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys])
    return t.join(s, on, "left_anti").unionByName(source.select(*target.columns))


def accumulate(target: DataFrame, source: DataFrame, keys: list[str], combine: dict[str, str]) -> DataFrame:
    """Matched rows combine their values: the least, the greatest, or the sum."""
    values = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*values).alias("t"))
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*values).alias("s"))
    on = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    out = []
    for c in values:
        a, b = F.col(f"t.{c}"), F.col(f"s.{c}")
        how = combine.get(c)
        if how in (LEAST, GREATEST):
            value = (F.least if how == LEAST else F.greatest)(a, b)
        elif how == ADD:
            value = F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        else:
            value = F.when(F.col("s").isNotNull(), b).otherwise(a)
        out.append(value.alias(c))
    both = t.join(s, on, "full_outer")
    pick = lambda k: F.when(F.col("t").isNotNull(), F.col(k)).otherwise(F.col(f"_s_{k}")).alias(k)
    return both.select(*[pick(k) for k in keys], *out).select(*target.columns)


def is_missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e)


class MetricTable:
    """A parquet table in a folder, partitioned by date columns, changed by whole partitions.

    A change reads only the partitions the source touches, stages the new content
    in the shared scratch folder and then replaces those partitions.

    With a `batch` id a change happens once. Its content is staged under the table
    and recorded as complete before the first partition is touched, and as done
    after the last. Run again, a batch that is done does nothing, one that died
    while it replaced partitions replaces them from what it had staged, and one that
    died earlier starts anew. Without an id, `accumulate` adds each time it is called
    and a job that dies while it replaces partitions may leave some of them empty.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], partitions: list[str]):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.partitions = keys, partitions

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as e:
            if not is_missing(e):
                raise
            return self.spark.createDataFrame([], self.schema)

    def _replace(self, rows: Callable[[], DataFrame], batch: str | None) -> None:
        """Overwrites exactly the partitions that occur in the rows."""
        if batch is None:
            self._overwrite(staged(rows().select(*self.schema.names), "stage"))
            return
        content, done = f"{self.path}/_batches/{batch}/content", f"{self.path}/_batches/{batch}/done"
        if exists(self.spark, done):
            return
        if not exists(self.spark, f"{content}/_SUCCESS"):
            rows().select(*self.schema.names).write.mode("overwrite").parquet(content)
        self._overwrite(self.spark.read.schema(self.schema).parquet(content))
        self.spark.range(1).write.mode("overwrite").parquet(done)

    def _overwrite(self, rows: DataFrame) -> None:
        (rows.hint("rebalance", *self.partitions)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partitions).parquet(self.path))

    def append(self, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("append").partitionBy(*self.partitions).parquet(self.path)

    def _source(self, rows: DataFrame) -> DataFrame:
        """The new rows, computed once although a change reads them three times. A key must not occur twice."""
        rows = staged(rows.select(*self.schema.names), "source")
        twice = rows.groupBy(*self.keys).count().where("count > 1").select(*self.keys).first()
        if twice is not None:
            raise ValueError(f"several new rows for the key {twice.asDict()}")
        return rows

    def _touched(self, source: DataFrame) -> DataFrame:
        # Dynamic partition pruning turns the semi join into a filter on the folders read.
        return self.read().join(source.select(*self.partitions).distinct(), self.partitions, "left_semi")

    def upsert(self, source: DataFrame, batch: str | None = None) -> None:
        """Replaces matching rows and adds new ones. The partition columns belong to the key."""
        def rows() -> DataFrame:
            new = self._source(source)
            return upsert(self._touched(new), new, self.keys)

        self._replace(rows, batch)

    def accumulate(self, source: DataFrame, combine: dict[str, str], batch: str | None = None) -> None:
        def rows() -> DataFrame:
            new = self._source(source)
            return accumulate(self._touched(new), new, self.keys, combine)

        self._replace(rows, batch)

    def refresh_days(self, rows: DataFrame, batch: str | None = None) -> None:
        """Replaces the days that occur in `rows`; one pass for all of them."""
        self._replace(lambda: rows, batch)


def merge_into(source: DataFrame, table: str, keys: list[str]) -> None:
    """The same upsert for a table of a row-level catalog."""
    source = source.alias("source")
    on = functools.reduce(operator.and_, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"source.{k}")) for k in keys])
    source.mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def last_days(df: DataFrame, column: str, day: dt.date, n: int) -> DataFrame:
    """Rows of `day` and the n-1 days before it."""
    return df.where(F.col(column).between(F.lit(day - dt.timedelta(days=n - 1)), F.lit(day)))


def create_metric_table(spark: SparkSession, name: str, columns: str, partitions: list[str], location: str,
                        fmt: str = "parquet") -> None:
    """Catalog table over a folder, created once."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
              f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}'")


def add_partitions(spark: SparkSession, name: str, rows: DataFrame, batch: int = 500) -> None:
    """Registers the partitions that a batch has written under a table's folder, told by its own rows.

    Nothing is listed, so the cost follows the batch and not the age of the table. The partitions of a batch are few (apps
    times days or hours) and go to the catalog in statements of `batch` each; those it knows already stay as they are.
    Rows with a null in a partition column are left to the writer's default folder.
    """
    columns = spark.catalog.listColumns(name)
    parts = [c.name for c in columns if c.isPartition]
    named = [F.col(c).cast("string").alias(c) for c in parts]
    found = rows.select(*named).dropna().distinct().orderBy(*parts).collect()
    for k in range(0, len(found), batch):
        specs = " ".join("PARTITION (" + ", ".join(f"`{c}` = {_quoted(r[c])}" for c in parts) + ")" for r in found[k:k + batch])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def append_rows(rows: DataFrame, name: str) -> None:
    """Appends to a catalog table; Spark registers the partitions that the write itself made."""
    rows.select(*rows.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def sync_partitions(spark: SparkSession, name: str, batch: DataFrame) -> DataFrame:
    """Registers the partitions of a batch of files and returns all partitions of the table."""
    add_partitions(spark, name, batch)
    return spark.sql(f"SHOW PARTITIONS {name}")


def expire(df: DataFrame, column: str, days: int) -> DataFrame:
    """Drops rows older than `days` before the table's own newest row."""
    newest = df.select(F.max(column).alias("newest")).scalar()
    return df.where(F.col(column) >= newest - F.make_dt_interval(F.lit(days)))


def expire_today(df: DataFrame, column: str, days: int, today: dt.date) -> DataFrame:
    """Drops rows with a date older than `days` before today."""
    return df.where(F.col(column) >= F.lit(today - dt.timedelta(days=days)))


def expire_sessions(sessions: DataFrame, keys: list[str], days: int) -> DataFrame:
    """The latest row per session, then expiry against the newest of them."""
    return expire(keep_one(sessions, keys, ["event_timestamp"]), "event_timestamp", days)
