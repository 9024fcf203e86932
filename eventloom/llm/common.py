"""What several of the operators share: reading tables, batch sizes, staging."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import eventloom
from eventloom.session import scratch

# Rows that an Arrow batch holds at most. Texts may be long, and a batch is in memory whole.
BATCH_ROWS = 1000


@functools.lru_cache(maxsize=1)
def _archive() -> str:
    root = Path(eventloom.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="eventloom-")) / "eventloom.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    return str(path)


@functools.lru_cache(maxsize=8)
def _sent(application: str) -> None:
    SparkContext.getOrCreate().addPyFile(_archive())


def python_steps(spark: SparkSession) -> None:
    """Makes Python steps planned from here on find this package on every executor, and bounds their Arrow batches
    unless they are smaller already."""
    _sent(spark.sparkContext.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    python_steps(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written in here drops its shuffle files when it is done. Otherwise they stay until the driver collects
    garbage, so a chain of steps holds the shuffles of many steps at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared scratch folder and read back, so that lost executors cost no recomputation."""
    path = scratch(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that labels are never learnt from; false where there is no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_struct(df: DataFrame, value: Column, names: list[str]) -> DataFrame:
    """Adds the fields of a struct as columns; input columns of the same names (in any case) give way."""
    taken = {n.lower() for n in names}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    hold = "__made"
    return df.select(*keep, value.alias(hold)).select(*keep, *[F.col(f"{hold}.{n}").alias(n) for n in names])


def stage_bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """Like ``stage``, with the rows dealt by a column: joins on it move the other side only."""
    spark = df.sparkSession
    path = scratch(spark, name)
    known = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_dropped(spark):
        (df.write.format("parquet").bucketBy(buckets, column).sortBy(column).option("path", path).option("compression", "zstd")
         .saveAsTable(known))
    rows = spark.table(known)
    rows.schema  # resolved here: only the name goes, the files stay
    spark.sql(f"DROP TABLE {known}")
    return rows
