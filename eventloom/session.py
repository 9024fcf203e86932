"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Runtime settings: UTC clocks, last value wins when two maps share a key,
# dynamic partition overwrite so that a refresh touches only its own days.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits a skewed join side even where that costs another shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # An upload is a whole list of events: batches sent to Python are bounded by rows and by bytes, whatever the table holds.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "200",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g", app: str = "eventloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``. Only where nothing is
    configured and everything runs on one machine (tests) is a temporary folder
    made and set; executors of a cluster would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = getattr(scratch, "fallback", None)
        if base is None:
            base = tempfile.mkdtemp(prefix="eventloom-")
            scratch.fallback = base
            spark.sparkContext.setCheckpointDir(os.path.join(base, "checkpoints"))
    return f"{base.rstrip('/')}/eventloom/{name}-{uuid.uuid4().hex[:12]}"


@functools.lru_cache(maxsize=8)
def _sent(application: str) -> None:
    root = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="eventloom-")) / "eventloom_core.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    SparkContext.getOrCreate().addPyFile(str(path))


def send_package(spark: SparkSession) -> None:
    """Lets Python state processors find this package on every executor, installed there or not."""
    _sent(spark.sparkContext.applicationId)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder in whatever store the path names."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def finished(spark: SparkSession, folder: str) -> list[str]:
    """Names of the subfolders that a write has completed; the list is as long as there are such writes."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(f.getPath().getParent().getName() for f in found or [])


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared scratch folder and read back: what reads them again, or loses an
    executor, does not compute them again."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
