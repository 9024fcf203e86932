"""Exact medians of groups of any size, without holding a group in one task."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import staged


def exact_medians(rows: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The median of `value` (a double) per group; null for a group without values, the mean of the middle two of an even number.

    Equal values of a group are counted together before the shuffle. The counts are dealt by ranges of (group, value), so
    a large group lies over many partitions in order. Their sizes, a row per group and partition, say which partitions
    hold the middle ranks; only there are ranks counted out, inside one partition's part of a group.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(value).alias("_n"))
    dealt = staged(counts.repartitionByRange(parts, *keys, "_v").withColumn("_part", F.spark_partition_id()), "values")
    group = Window.partitionBy(*keys)
    sizes = dealt.groupBy(*keys, "_part").agg(F.sum("_n").alias("_size"))
    placed = sizes.select("*", F.sum("_size").over(group).alias("_all"),
                          (F.sum("_size").over(group.orderBy("_part")) - F.col("_size")).alias("_before"))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    holds = lambda rank: (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_size"))
    wanted = placed.where(holds(low) | holds(high))
    same = functools.reduce(operator.and_, [F.col(f"w.{k}").eqNullSafe(F.col(f"d.{k}")) for k in [*keys, "_part"]])
    near = dealt.where("_n > 0").alias("d").join(wanted.alias("w"), same).select("d.*", "_all", "_before")
    inside = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = near.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    at = lambda rank: F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), F.col("_v")))
    found = ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias(name))
    none = sizes.groupBy(*keys).agg(F.sum("_size").alias("_all")).where("_all = 0").select(*keys, F.lit(None).cast("double").alias(name))
    return found.unionByName(none)
