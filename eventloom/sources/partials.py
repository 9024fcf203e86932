"""A table kept as mergeable rows by batch: writers only append, readers fold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import exists, finished


class PartialLog:
    """Rows of a batch under the batch's number; `fold` makes one row per key of any union of them.

    A batch writes its own rows only, whatever the size of the table. Written again after a failure it replaces
    what it had begun, and once complete it is left as it is, so a replayed batch changes nothing. Readers take
    complete batches only. `fold` gets the rows with their `batch` and must give the same for rows that were folded
    before: then `compact` may write the folded rows of all batches so far as a new base, beside the old one, and
    the next read starts from there. Nothing is changed in place.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.fold = spark, path.rstrip("/"), fold
        self.schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])

    def append(self, rows: DataFrame, batch: int) -> None:
        target = f"{self.path}/batches/{batch}"
        if not exists(self.spark, f"{target}/_SUCCESS"):
            rows.withColumn("batch", F.lit(batch).cast("long")).select(*self.schema.names).write.mode("overwrite").parquet(target)

    def _parts(self) -> list[str]:
        """The newest base, and the complete batches after it."""
        bases, batches = (finished(self.spark, f"{self.path}/{kind}") for kind in ("bases", "batches"))
        base = max(map(int, bases), default=-1)
        return [f"{self.path}/bases/{base}"] * (base >= 0) + [f"{self.path}/batches/{b}" for b in batches if int(b) > base]

    def rows(self) -> DataFrame:
        parts = self._parts()
        return self.spark.read.schema(self.schema).parquet(*parts) if parts else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """One row per key, of all complete batches."""
        return self.fold(self.rows())

    def compact(self) -> None:
        """Writes the folded rows as the base up to the last complete batch. Batches are numbered as they are written."""
        done = finished(self.spark, f"{self.path}/batches")
        if done:
            upto = max(map(int, done))
            target = f"{self.path}/bases/{upto}"
            if not exists(self.spark, f"{target}/_SUCCESS"):
                self.read().select(*self.schema.names).write.mode("overwrite").parquet(target)
