"""Browser, system and device from the user agent text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import spread_nulls

# Family and version pattern, first match wins. Fixed values.
BROWSERS = [
    ("Edge", r"Edg(?:e|A|iOS)?/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Opera", r"(?:OPR|Opera)/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Samsung Internet", r"SamsungBrowser/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Firefox", r"(?:Firefox|FxiOS)/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Chrome", r"(?:Chrome|CriOS)/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Safari", r"Version/(\d+)(?:\.(\d+))?(?:\.(\d+))?.*Safari/"),
    ("IE", r"(?:MSIE |Trident/.*rv:)(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Apache-HttpClient", r"Apache-HttpClient/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("curl", r"curl/(\d+)(?:\.(\d+))?(?:\.(\d+))?"),
]
SYSTEMS = [
    ("iOS", r"(?:iPhone|iPad|iPod).*? OS (\d+)(?:_(\d+))?(?:_(\d+))?"),
    ("Android", r"Android (\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Windows", r"Windows NT (\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Mac OS X", r"Mac OS X (\d+)(?:[._](\d+))?(?:[._](\d+))?"),
    ("Chrome OS", r"CrOS \S+ (\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Linux", r"Linux(?: \S+?(\d+)(?:\.(\d+))?(?:\.(\d+))?;)?"),
]
DEVICES = [
    ("Spider", r"(?i)bot\b|bot/|spider|crawl|slurp"),
    ("iPhone", r"iPhone"), ("iPad", r"iPad"), ("Kindle", r"Kindle|Silk/"),
    ("Generic Tablet", r"(?i)tablet|Android(?!.*Mobile)"), ("Generic Smartphone", r"Android.*Mobile|Mobile"),
    ("Mac", r"Macintosh"), ("PC", r"Windows NT"), ("Linux", r"Linux|CrOS"),
]


def _version(ua: Column, pattern: str) -> Column:
    parts = [F.nullif(F.regexp_extract(ua, pattern, i), F.lit("")) for i in (1, 2, 3)]
    return F.nullif(F.array_join(F.array_compact(F.array(*parts)), "."), F.lit(""))


def _first(ua: Column, table: list[tuple[str, str]], value) -> Column:
    out = None
    for name, pattern in table:
        v = value(name, pattern)
        out = F.when(ua.rlike(pattern), v) if out is None else out.when(ua.rlike(pattern), v)
    return out


def category(device: Column) -> Column:
    """Bot, Mobile, Tablet, PC or Other by words of the device family."""
    low = F.lower(device)
    has = lambda *words: low.rlike("|".join(words))
    return (
        F.when(device.isNull(), None)
        .when(has("bot") | device.isin("Spider", "Crawler"), "Bot").when(has("mobile", "phone"), "Mobile")
        .when(has("tablet", "pad", "kindle"), "Tablet").when(has("pc", "mac", "linux"), "PC").otherwise("Other"))


RULES = "kind string, priority int, token string, pattern string, name string, version string"


def _by_patterns(agents: DataFrame) -> DataFrame:
    u = F.col("_ua")
    name = lambda table: F.coalesce(_first(u, table, lambda n, p: F.lit(n)), F.lit("Other"))
    device = name(DEVICES)
    return agents.select(
        "_ua", name(BROWSERS).alias("device_ua_browser"),
        _first(u, BROWSERS, lambda n, p: _version(u, p)).alias("device_ua_browser_version"),
        name(SYSTEMS).alias("device_ua_os"),
        _first(u, SYSTEMS, lambda n, p: _version(u, p)).alias("device_ua_os_version"),
        device.alias("device_ua_device"), category(device).alias("device_ua_device_category"))


def _by_rules(agents: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule of least priority per agent and kind, out of those whose token the agent has and whose pattern it fits.

    The tokens are an inverted index: an agent meets only the rules that one of its words names, however many there are.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("_ua"), F.lit("[a-z0-9]+"), F.lit(0)))
    told = agents.select("_ua", F.explode(words).alias("token")).join(rules.withColumn("token", F.lower("token")), "token")
    version = F.when(F.col("version").isNotNull(), F.nullif(F.translate(F.expr("regexp_extract(_ua, version, 1)"), "_", "."), F.lit("")))
    hits = told.where(F.regexp_like("_ua", F.coalesce("pattern", F.lit("")))).select("_ua", "kind", "priority", "name", version.alias("version"))

    def best(kind: str):
        own = F.col("kind") == kind
        return F.min_by(F.when(own, F.struct("name", "version")), F.when(own, F.struct("priority", "name"))).alias(kind)

    found = agents.join(hits.groupBy("_ua").agg(best("browser"), best("os"), best("device")), "_ua", "left")
    name = lambda kind: F.coalesce(F.col(f"{kind}.name"), F.lit("Other"))
    return found.select(
        "_ua", name("browser").alias("device_ua_browser"), F.col("browser.version").alias("device_ua_browser_version"),
        name("os").alias("device_ua_os"), F.col("os.version").alias("device_ua_os_version"),
        name("device").alias("device_ua_device"), category(name("device")).alias("device_ua_device_category"))


def parse_ua(events: DataFrame, ua: str = "ua", rules: DataFrame | None = None) -> DataFrame:
    """Parses each distinct user agent once and joins the result back.

    With `rules` (columns RULES) families come from that table alone: a rule belongs to a kind (browser, os, device), is
    looked up by one word of the agent, holds where its pattern (null: always) is found, and reads the version with the one group
    of its version pattern (null: none). The least priority wins, then the name; a kind without a rule that fits is Other. Without `rules` a
    short built-in list decides.
    """
    agents = events.where(F.col(ua).isNotNull()).select(F.col(ua).alias("_ua")).distinct()
    parsed = _by_patterns(agents) if rules is None else _by_rules(agents, rules)
    kept = events.drop(*[c for c in parsed.columns if c in events.columns])
    return kept.join(parsed, spread_nulls(kept, ua) == F.col("_ua"), "left").drop("_ua")
