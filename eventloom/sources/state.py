"""State kept between runs: a dated log of increments, compacted now and then."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eventloom.operators.upsert import is_missing


class StateTable:
    """Increments by update date under a numbered version.

    Rows whose own time (`time`, a timestamp column) is older than the kept days are
    dropped too: compaction stamps what it keeps with its own day, so the update date
    alone would let old rows live for ever.

    Compaction writes the merged rows as the next version and then records it as
    committed; until then readers stay on the old one. Nothing is overwritten, so
    a lost executor or driver leaves the table readable.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep_days: int, time: str | None = None):
        self.spark, self.path, self.schema, self.keep_days, self.time = spark, path, schema, keep_days, time

    def _log(self, version: int) -> str:
        return f"{self.path}/log_v{version}"

    def version(self) -> int:
        try:
            row = self.spark.read.schema("version int").parquet(f"{self.path}/commits").agg(F.max("version")).first()
            return row[0] or 0
        except AnalysisException as e:
            if not is_missing(e):
                raise
            return 0

    def append(self, rows: DataFrame, day: dt.date) -> None:
        self._write(rows, self.version(), day)

    def _write(self, rows: DataFrame, version: int, day: dt.date) -> None:
        (rows.select(*self.schema.names).withColumn("update_date", F.lit(day.strftime("%Y%m%d")))
         .write.mode("append").partitionBy("update_date", "app_id").parquet(self._log(version)))

    def read(self, today: dt.date) -> DataFrame:
        """Increments of the kept days; the folders of older days are not opened."""
        first = today - dt.timedelta(days=self.keep_days)
        since = first.strftime("%Y%m%d")
        full = T.StructType(self.schema.fields + [T.StructField("update_date", T.StringType())])
        try:
            rows = self.spark.read.schema(full).parquet(self._log(self.version()))
        except AnalysisException as e:
            if not is_missing(e):
                raise
            return self.spark.createDataFrame([], self.schema)
        kept = rows.where(F.col("update_date") >= since).drop("update_date")
        return kept if self.time is None else kept.where(F.col(self.time) >= F.lit(first).cast("timestamp"))

    def compact(self, merge: Callable[[DataFrame], DataFrame], today: dt.date) -> None:
        following = self.version() + 1
        self._write(merge(self.read(today)), following, today)
        self.spark.createDataFrame([(following,)], "version int").write.mode("append").parquet(f"{self.path}/commits")
