"""Where traffic came from: campaign parameters, referrer category, channel group."""

from __future__ import annotations

import functools
import json
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import url
from eventloom.functions.let import let
from eventloom.functions.text import spread_nulls
from eventloom.names import DIRECT

UNASSIGNED = "Unassigned"
INTERNAL = "Internal"
EMPTY = "__empty__"

# Parameter -> traffic source field. Fixed values.
UTM = {"source": "utm_source", "medium": "utm_medium", "campaign": "utm_campaign", "content": "utm_content",
       "term": "utm_term", "campaign_id": "utm_id", "clid_platform": "utm_source_platform"}


# ------------------------------------------------------------ campaign params

def utm(page_url: Column) -> Column:
    """Struct of traffic fields from a URL's campaign parameters and click id.

    gclid stands for Google paid clicks; any other parameter ending in clid names
    its source. A medium that is only inferred is put in parentheses.
    """
    bare = F.nullif(page_url, F.lit(""))
    full = F.when(bare.contains("://"), bare).otherwise(F.concat(F.lit("http://"), bare))
    return let(url.pairs(url.query(full)), _utm_fields)


def _utm_fields(p: Column) -> Column:
    get = lambda name: url.first_param(p, name)
    other = F.try_element_at(F.filter(p, lambda x: x["k"].endswith("clid")), F.lit(1))
    clid_type = F.when(get("gclid").isNotNull(), F.lit("gclid")).otherwise(other["k"])
    clid_value = F.coalesce(get("gclid"), F.nullif(other["v"], F.lit("")))
    inferred = get("utm_source").isNull() & clid_type.isNotNull()
    named = F.when(clid_type == "gclid", F.lit("Google")).otherwise(clid_type)
    fields = {f: get(name) for f, name in UTM.items()}
    fields["source"] = F.when(inferred, named).otherwise(get("utm_source"))
    fields["medium"] = F.coalesce(get("utm_medium"), F.when(inferred, F.lit("(CPC)")))
    fields["clid"] = F.when(clid_type.isNotNull(), F.to_json(F.struct(clid_type.alias("type"), clid_value.alias("value"))))
    return F.struct(*[c.alias(n) for n, c in fields.items()])


# ---------------------------------------------------------- referrer category

def category_rules(spark, rules: list[dict]) -> DataFrame:
    """Rules {url, source, category, params} as a relation; a repeated URL keeps its last entry."""
    last = {r["url"]: (r["url"], r["source"], r["category"], list(r.get("params", []))) for r in rules}
    return spark.createDataFrame(list(last.values()) or [("", None, None, [])],
                                 "url string, source string, category string, params array<string>")


def candidates(referrer: Column, host: Column, path: Column) -> Column:
    """Forms of a referrer under which it may be listed; `host` is not null."""
    has_path = F.coalesce((path != "") & (path != "/"), F.lit(False))
    bare = F.when(host.startswith("www."), F.substring(host, F.lit(5), F.length(host)))
    # A country suffix is dropped: shop.co.uk is also looked up as shop.co. The pattern is a fixed value.
    short = lambda h: F.nullif(F.regexp_extract(h, r"^(.*\.[a-z]{2,3})\.[a-z]{2}$", 1), F.lit(""))
    rest = F.when(referrer.contains("://"), F.try_element_at(F.split(referrer, "://"), F.lit(2))).otherwise(referrer)
    forms = F.array(
        rest, F.when(has_path, F.concat(host, path)), host, bare, F.when(has_path, F.concat(bare, path)),
        short(host), short(bare), F.when(referrer.contains(".google."), F.lit("google.com")))
    return F.array_distinct(F.array_compact(forms))


def _terms(pair_list: Column, names: Column) -> Column:
    """Values of the listed parameters, distinct and sorted."""
    values = F.filter(pair_list, lambda p: F.array_contains(names, p["k"]) & p["v"].isNotNull())
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(
        F.transform(values, lambda p: p["v"]))), ","), F.lit(""))


def referrer_category(df: DataFrame, referrer: str, rules: DataFrame) -> DataFrame:
    """Adds ref_source, ref_category and ref_terms; the longest listed form wins.

    Distinct referrers are matched, not rows, and joined back; the matching cost
    does not depend on how often a referrer occurs.
    """
    r = F.col("_r")
    known = df.where(F.coalesce(F.col(referrer), F.lit("")) != "").select(F.col(referrer).alias("_r")).distinct()
    known = known.select("_r", url.host(r).alias("_h"), url.path(r).alias("_p"))
    forms = candidates(r, F.coalesce("_h", F.lit("")), F.col("_p"))
    # Grouping keeps the referrers without a hit, so the list is read once and not joined to itself.
    facts = (
        known.select("_r", "_h", F.explode(forms).alias("url")).join(rules, "url", "left")
        .groupBy("_r", "_h").agg(F.max_by(
            F.struct("source", "category", "params"),
            F.when(F.col("category").isNotNull(), F.struct(F.length("url"), "url"))).alias("hit"))
        .select(
            "_r",
            F.when(F.col("hit").isNull(), F.col("_h")).otherwise(F.col("hit.source")).alias("ref_source"),
            F.coalesce(F.col("hit.category"), F.lit(UNASSIGNED)).alias("ref_category"),
            _terms(url.pairs(url.query(r)), F.col("hit.params")).alias("ref_terms"))
    )
    return df.join(facts, spread_nulls(df, referrer) == F.col("_r"), "left").drop("_r")


# -------------------------------------------------------------- channel group

PAID = "^(.*cp.*|ppc|retargeting|paid.*)$"
SHOP = "^(.*(([^a-df-z]|^)shop|shopping).*)$"


def _is(field: str, op: str, value) -> dict:
    key = "values" if isinstance(value, list) else "value"
    return {"field": field if field.startswith("page_") else f"traffic_source_{field}", "op": op, key: value}


def _all(*items) -> dict:
    return {"op::and": list(items)}


def _any(*items) -> dict:
    return {"op::or": list(items)}


def _paid(category: str, *more) -> dict:
    return _all(_is("category", "eq", category), _any(_is("medium", "match", PAID), _is("clid", "not_eq", EMPTY), *more))


LATEST, LATEST_HOST = "page_view_latest_referrer", "page_view_latest_referrer_host"
# The default channels in order of precedence. Fixed values.
DEFAULT_CHANNELS = [
    {"channel": "Direct", "condition": _all(*[_is(f, "eq", EMPTY) for f in (
        "category", "source", "medium", "campaign", "content", "term", "campaign_id", "clid_platform", "clid")])},
    {"channel": "Paid Search", "condition": _paid("Search")},
    {"channel": "Organic Search", "condition": _all(
        _is("category", "eq", "Search"), _any(_is("medium", "eq", EMPTY), _is("medium", "eq", "organic")))},
    {"channel": "Paid Social", "condition": _paid("Social")},
    {"channel": "Organic Social", "condition": _any(
        _is("category", "eq", "Social"),
        _is("medium", "in", ["social", "social-network", "social-media", "sm", "social network", "social media"]))},
    {"channel": "Paid Video", "condition": _paid("Video")},
    {"channel": "Organic Video", "condition": _any(
        _is("category", "eq", "Video"), _is("medium", "match", "^(.*video.*)$"))},
    {"channel": "Paid Shopping", "condition": _paid("Shopping", _is("campaign", "match", SHOP))},
    {"channel": "Organic Shopping", "condition": _any(
        _is("category", "eq", "Shopping"), _is("campaign", "match", SHOP))},
    {"channel": "Paid Other", "condition": _all(_is("category", "eq", EMPTY), _is("medium", "match", PAID))},
    {"channel": "Email", "condition": _any(
        _is("source", "contain", "mail"), _is("medium", "contain", "mail"), _is(LATEST_HOST, "start_with", "mail"))},
    {"channel": "SMS", "condition": _any(_is("source", "eq", "sms"), _is("medium", "eq", "sms"))},
    {"channel": "Audio", "condition": _all(_is("medium", "eq", "audio"))},
    {"channel": "Mobile Push Notifications", "condition": _any(
        _is("medium", "end_with", "push"), _is("medium", "contain", "mobile"), _is("medium", "contain", "notification"))},
    {"channel": "Referral", "condition": _all(
        _is(LATEST, "not_eq", EMPTY), _is("category", "eq", EMPTY), _is(LATEST_HOST, "not_match", "^.*internal.*$"))},
    {"channel": "Internal", "condition": _all(_is(LATEST_HOST, "match", "^.*internal.*$"))},
]

OPERATORS = {
    "eq": lambda c, v: c == v,
    "contain": lambda c, v: c.contains(v),
    "start_with": lambda c, v: c.startswith(v),
    "end_with": lambda c, v: c.endswith(v),
    "match": lambda c, v: c.rlike(f"^(?:{v})$"),
}


def _compile(node: dict, columns: dict[str, Column]) -> Column:
    kinds = [k for k in ("field", "op::and", "op::or") if node.get(k) is not None]
    if len(kinds) != 1:
        raise ValueError(f"a rule node needs exactly one of field, op::and, op::or: {node}")
    if kinds[0] != "field":
        join = operator.and_ if kinds[0] == "op::and" else operator.or_
        return functools.reduce(join, [_compile(n, columns) for n in node[kinds[0]]])
    field, op = node["field"], node.get("op")
    if field not in columns:
        raise ValueError(f"unknown rule field {field}")
    low = F.lower(columns[field])
    if op in ("in", "not_in"):
        values = [v.lower() for v in node.get("values") or []]
        if not values:
            raise ValueError(f"{op} needs values: {node}")
        listed = F.coalesce(low.isin(values), F.lit(False))
        return listed if op == "in" else ~listed
    name = op.removeprefix("not_") if op else op
    if name not in OPERATORS or node.get("value") is None:
        raise ValueError(f"unknown operator or missing value: {node}")
    value = "" if node["value"] == EMPTY else node["value"].lower()
    hit = OPERATORS[name](F.coalesce(low, F.lit("")), value)
    return ~hit if op.startswith("not_") else hit


def channel_group(rules: list[dict] | str, columns: dict[str, Column]) -> Column:
    """The channel of the first matching rule, as one nested condition."""
    rules = json.loads(rules) if isinstance(rules, str) else rules
    out = None
    for rule in rules:
        hit = _compile(rule["condition"], columns)
        out = F.when(hit, F.lit(rule["channel"])) if out is None else out.when(hit, F.lit(rule["channel"]))
    return F.lit(UNASSIGNED) if out is None else out.otherwise(F.lit(UNASSIGNED))


# -------------------------------------------------------------- traffic source

FIELDS = ["source", "medium", "campaign", "content", "term", "campaign_id", "clid_platform", "clid"]
INFERRED_REFERRAL = ["Social", "Video", "Shopping", "Referral"]


def traffic_source(df: DataFrame, rules: list[dict], channels: list[dict] | None = None) -> DataFrame:
    """Fills the traffic source of rows whose client did not set one.

    Campaign parameters come from the page, else the latest referrer, else the
    referrer. A referrer on the page's own host is ignored. Needs the columns
    raw_page_url, raw_page_referrer, raw_latest_referrer,
    page_view_latest_referrer_host and traffic_source_*; keeps all others.
    """
    spark = df.sparkSession
    relation = category_rules(spark, rules)
    by_source = list({r["source"]: r["category"] for r in rules}.items())
    sources = spark.createDataFrame(by_source or [(None, None)], "_listed_source string, _listed string")
    page, ref, latest = F.col("raw_page_url"), F.col("raw_page_referrer"), F.col("raw_latest_referrer")
    latest_host = F.col("page_view_latest_referrer_host")
    set_by_client = F.coalesce(F.col("traffic_source_source"), F.lit("")) != ""
    # A client that says Direct says nothing about the source.
    real = lambda f: F.when(F.lower(F.col(f"traffic_source_{f}")) != "direct", F.col(f"traffic_source_{f}"))
    names = [*UTM, "clid"]  # the order of the fields in `utm`
    client = F.struct(*[(real(f) if f in ("source", "medium", "campaign") else F.col(f"traffic_source_{f}")).alias(f)
                        for f in names])
    found = F.when(F.col("_u_page.source").isNotNull(), F.col("_u_page")).when(
        F.col("_u_latest.source").isNotNull(), F.col("_u_latest")).otherwise(F.col("_u_ref"))
    page_host, ref_host = F.col("_page_host"), F.col("_own_host")
    has_latest, has_ref = F.coalesce(latest, F.lit("")) != "", F.coalesce(ref, F.lit("")) != ""
    own_latest = F.coalesce(page_host == F.lower(latest_host), F.lit(False))
    own_ref = F.coalesce(page_host == F.lower(ref_host), F.lit(False))
    use_latest, use_ref = has_latest & ~own_latest, has_ref & ~own_ref
    rows = df.withColumns({
        "_u_page": utm(page), "_u_latest": utm(latest), "_u_ref": utm(ref),
        "_page_host": F.lower(url.host(page)), "_own_host": url.host(ref),
    }).withColumns({
        "_set": set_by_client,
        "_utm": F.when(set_by_client & client["source"].isNotNull(), client).otherwise(found),
        "_ref": F.when(use_latest, latest).when(use_ref, ref),
        "_ref_host": F.when(use_latest, latest_host).when(use_ref, ref_host),
        "_inside": F.when(has_latest, own_latest).otherwise(F.when(has_ref, own_ref).otherwise(F.lit(False))),
        "_none": ~has_latest & ~has_ref,
    })
    rows = referrer_category(rows, "_ref", relation)
    source = F.coalesce("_utm.source", "ref_source")
    rows = rows.withColumn("_source", source).join(sources, F.col("_source") == F.col("_listed_source"), "left")
    open_category = source.isNotNull() & F.coalesce(F.col("ref_category") == UNASSIGNED, F.lit(True))
    rows = rows.withColumn("_category", F.when(open_category, F.col("_listed")).otherwise(F.col("ref_category")))
    by_category = (
        F.when(F.col("_category").isNotNull() & F.col("_utm.clid").isNotNull(), "(CPC)")
        .when(F.col("_category") == "Search", "(Organic)")
        .when(F.col("_category").isin(INFERRED_REFERRAL), "(Referral)"))
    rows = rows.withColumn("_medium", F.coalesce("_utm.medium", by_category))
    inputs = {
        "traffic_source_category": F.nullif(F.col("_category"), F.lit(UNASSIGNED)),
        "traffic_source_source": F.col("_source"),
        "traffic_source_medium": F.translate(F.col("_medium"), "()", ""),
        "traffic_source_campaign": F.col("_utm.campaign"), "traffic_source_content": F.col("_utm.content"),
        "traffic_source_term": F.coalesce("_utm.term", "ref_terms"),
        "traffic_source_campaign_id": F.col("_utm.campaign_id"),
        "traffic_source_clid_platform": F.col("_utm.clid_platform"), "traffic_source_clid": F.col("_utm.clid"),
        LATEST: F.col("_ref"), LATEST_HOST: F.col("_ref_host"),
    }
    # Inputs become columns first: the rules mention each of them many times.
    rows = rows.withColumns({f"_in_{name}": value for name, value in inputs.items()})
    channel = channel_group(channels or DEFAULT_CHANNELS, {name: F.col(f"_in_{name}") for name in inputs})
    # Without any source a referring host still names one; otherwise the visit is direct.
    named = F.coalesce(F.col("_source"), F.when(F.col("_ref").isNotNull(), F.col("_ref_host")))
    direct = named.isNull()
    campaign = F.when(F.col("_source").isNull() & F.col("_ref").isNull(), F.lit(DIRECT)).otherwise(F.col("_utm.campaign"))
    by_referrer = F.when(F.col("_none") | F.col("_inside"), "None").otherwise("(Referral)")
    filled = {
        "source": F.when(direct, F.lit(DIRECT)).otherwise(named),
        "medium": F.coalesce(F.col("_medium"), by_referrer),
        "campaign": campaign,
        "content": F.col("_utm.content"),
        "term": F.coalesce("_utm.term", "ref_terms"),
        "campaign_id": F.col("_utm.campaign_id"),
        "clid_platform": F.col("_utm.clid_platform"),
        "clid": F.col("_utm.clid"),
        "channel_group": F.when(direct, F.when(F.col("_inside"), INTERNAL).otherwise(DIRECT)).otherwise(channel),
        "category": F.when(direct, F.lit(DIRECT)).otherwise(F.coalesce(F.col("_category"), F.lit(UNASSIGNED))),
    }
    out = {}
    for f, value in filled.items():
        kept = F.col(f"traffic_source_{f}")
        # A client that sets the source keeps its fields; only channel and category are completed.
        if f in ("channel_group", "category"):
            complete = F.col("traffic_source_channel_group").isNotNull() & F.col("traffic_source_category").isNotNull()
            out[f"traffic_source_{f}"] = F.when(F.col("_set") & complete, kept).otherwise(value)
        else:
            out[f"traffic_source_{f}"] = F.when(F.col("_set"), kept).otherwise(value)
    keep = [c for c in df.columns if c not in out]
    return rows.select(*keep, *[c.alias(n) for n, c in out.items()])

