"""Rule files: one JSON document per file, in a folder per app."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.fields import FieldRule


def load_rules(spark: SparkSession, base: str) -> DataFrame:
    """(app, file, text) of every *.json below `base`; the app is the folder's name."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(base))
    parts = F.split("path", "/")
    folder = F.regexp_replace(F.element_at(parts, -2), "^app_id=", "")
    return files.select(folder.alias("app"), F.element_at(parts, -1).alias("file"),
                        F.decode("content", "UTF-8").alias("text"))


def rules_by_app(rules: DataFrame) -> dict[str, list]:
    """Configuration for the driver: rule files are small and few (one or two per app)."""
    return {r["app"]: json.loads(r["text"]) for r in rules.select("app", "text").toLocalIterator()}


def field_rules(rules: DataFrame) -> dict[str, FieldRule]:
    return {app: FieldRule(doc["filterMode"], tuple(doc.get("fields") or ()))
            for app, doc in rules_by_app(rules).items() if doc.get("filterMode")}
