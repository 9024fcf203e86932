"""URL parts and query parameters as Column expressions. A broken URL gives nulls, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.let import let

PAIR = "array<struct<k:string,v:string>>"


def decode(c: Column) -> Column:
    """Percent decoding; text that does not decode stays as it is."""
    coded = c.contains("%") | c.contains("+")
    return F.when(coded, F.coalesce(F.try_url_decode(c), c)).otherwise(c)


def with_scheme(url: Column) -> Column:
    """Adds https:// where the text does not start with a scheme; empty becomes null."""
    bare = F.nullif(url, F.lit(""))
    return F.when(bare.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), bare).otherwise(F.concat(F.lit("https://"), bare))


def _part(url: Column, part: str, pattern: str) -> Column:
    """A URL part by the strict parser; by pattern only where that one rejects the text."""
    return let(with_scheme(url), lambda full: F.coalesce(
        F.try_parse_url(full, F.lit(part)), F.nullif(F.regexp_extract(full, pattern, 1), F.lit(""))))


def host(url: Column) -> Column:
    """Host name."""
    return _part(url, "HOST", r"^[^:]+://(?:[^/?#@]*@)?([A-Za-z0-9.\-]+)")


def path(url: Column) -> Column:
    """Decoded path; empty for a URL without one."""
    raw = F.coalesce(_part(url, "PATH", r"^[^:]+://[^/?#]*([^?#]*)"), F.when(url != "", F.lit("")))
    return F.when(raw.contains("%"), decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)


def query(url: Column) -> Column:
    """Query text; no question mark, no query: most URLs stop here."""
    return F.nullif(_part(F.when(url.contains("?"), url), "QUERY", r"\?([^#]*)"), F.lit(""))


def pairs(query_text: Column) -> Column:
    """(key, value) in order; a key without a value has null."""
    def split(p: Column) -> Column:
        at = F.instr(p, "=")
        return F.struct(
            decode(F.when(at > 1, F.substring(p, 1, at - 1)).otherwise(p)).alias("k"),
            decode(F.when((at > 1) & (F.length(p) > at), F.substring(p, at + 1, F.length(p)))).alias("v"))
    return F.transform(F.split(query_text, "&"), split)


def params(pair_list: Column) -> Column:
    """Query map; repeated keys join their values with commas."""
    def build(p: Column) -> Column:
        keys = F.transform(p, lambda x: x["k"])
        joined = lambda k: F.array_join(F.transform(F.filter(p, lambda x: x["k"] == k), lambda x: x["v"]), ",")
        single = F.map_from_entries(F.transform(p, lambda x: F.struct(x["k"], F.coalesce(x["v"], F.lit("")))))
        distinct = F.array_distinct(keys)
        # Repeated keys are rare; without them the pairs are the map.
        return F.when(F.size(distinct) == F.size(p), single).otherwise(
            F.map_from_arrays(distinct, F.transform(distinct, joined)))
    return F.when(pair_list.isNotNull(), let(pair_list, build))


def first_param(pair_list: Column, name: str | Column) -> Column:
    """First value of a parameter, null when missing or empty."""
    hit = F.filter(pair_list, lambda p: p["k"] == name)
    return F.nullif(F.try_element_at(hit, F.lit(1))["v"], F.lit(""))
