"""Location of an IP address from a range table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import spread_nulls

GEO = ["geo_city", "geo_continent", "geo_country"]
PREFIX = 65_536  # one bucket per /16 network


def first_ip(c: Column) -> Column:
    """Proxies send a list; the first address is the client."""
    return F.trim(F.split(c, ",")[0])


def ip_number(c: Column) -> Column:
    """IPv4 text as a number; anything else is null."""
    parts = F.split(c, r"\.")
    octet = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("bigint")
    value = ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)
    return F.when(c.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), value)


def geo_ip(events: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Fills city, continent and country; a known value is never replaced by null.

    `ranges` holds first, last (numbers, inclusive), city, continent, country.
    Distinct addresses meet the ranges on their /16 bucket, so the range join is
    an equi join with a residual; the narrowest range wins. The result is joined
    back on the address text; a very frequent address is split by the adaptive
    skew join.
    """
    known = events.where(F.col(ip).isNotNull()).select(F.col(ip).alias("_ip")).distinct().withColumn(
        "_n", ip_number(first_ip(F.col("_ip")))).where(F.col("_n").isNotNull())
    bucketed = ranges.withColumn("_bucket", F.explode(F.sequence(
        F.floor(F.col("first") / PREFIX), F.floor(F.col("last") / PREFIX))))
    found = (
        known.withColumn("_bucket", F.floor(F.col("_n") / PREFIX)).join(bucketed, "_bucket")
        .where(F.col("_n").between(F.col("first"), F.col("last")))
        .groupBy("_ip").agg(F.min_by(F.struct("city", "continent", "country"),
                                     F.struct(F.col("last") - F.col("first"), F.col("first"))).alias("g"))
    )
    out = events.join(found, spread_nulls(events, ip) == F.col("_ip"), "left").drop("_ip")
    old = lambda c: F.col(c) if c in events.columns else F.lit(None).cast("string")
    return out.withColumns({c: F.coalesce(F.col(f"g.{c.removeprefix('geo_')}"), old(c)) for c in GEO}).drop("g")
