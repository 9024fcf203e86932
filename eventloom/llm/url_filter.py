"""URL rules looked up in a sorted array of 64-bit digests.

Every rule is a string: a host followed by the start of a path. Its xxhash64 goes into one sorted array,
kept in a file beside the full strings. Tasks map that file into memory, hash every rule a URL could fit
(each parent domain with each path prefix that has the length of some rule's path), find the digests by a
vectorised binary search, and compare the stored strings, so that equal digests of unequal strings never
decide. Of several fitting rules the longest wins, at equal length the one with the longer host.

Up to ``MAX_INDEX_BYTES`` of rules the file is built on the driver and sent once to each executor. A larger
rule table stays a table: the candidate strings of the distinct URLs are joined with it instead.
"""

from __future__ import annotations

import functools
import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import with_struct

ALLOW, BLOCK = "allow", "block"
MAX_INDEX_BYTES = 64 << 20
# Bytes of a rule in the index beside its string: digest, offset, verdict.
_PER_RULE = 17

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters lower-cased. Path: from there
    up to ``?``, ``#`` or the end. Both are empty for a null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return F.translate(raw, _UPPER, _LOWER), F.regexp_extract(after, r"^[^?#]*", 0)


def build_index(rules: Iterable[tuple[str, str, str]], folder: str) -> str:
    """Writes the index of (host, path, verdict) rules and gives the file's path. A rule that is listed as both
    allowed and blocked blocks."""
    verdicts: dict[str, int] = {}
    for host, path, verdict in rules:
        verdicts[key] = max(verdicts.get(key := host + path, 0), int(verdict == BLOCK))
    keyed = sorted((xxhash.xxh64_intdigest(k), k) for k in verdicts)
    strings = [k.encode() for _, k in keyed]
    lengths = sorted({len(k) - _host_length(k) for k in verdicts})
    head = np.array([len(keyed), len(lengths), *lengths], np.int64)
    offsets = np.zeros(len(keyed) + 1, np.int64)
    np.cumsum([len(s) for s in strings], out=offsets[1:])
    body = b"".join([head.tobytes(), np.array([d for d, _ in keyed], np.uint64).tobytes(), offsets.tobytes(),
                     bytes(verdicts[k] for _, k in keyed), *strings])
    path = os.path.join(folder, f"rules-{hashlib.sha256(body).hexdigest()[:24]}.bin")
    with open(path, "wb") as out:
        out.write(body)
    return path


def _host_length(rule: str) -> int:
    cut = rule.find("/")
    return len(rule) if cut < 0 else cut


class Index:
    """The mapped file. Nothing is read but the pages that a search touches."""

    def __init__(self, path: str):
        self.raw = np.memmap(path, np.uint8, "r")
        n, m = self.raw[:16].view(np.int64)
        at = 16 + 8 * m
        self.lengths = self.raw[16:at].view(np.int64).tolist()
        self.digests = self.raw[at:(at := at + 8 * n)].view(np.uint64)
        self.offsets = self.raw[at:(at := at + 8 * (n + 1))].view(np.int64)
        self.blocks = self.raw[at:(at := at + n)]
        self.start = at

    def stored(self, k: int) -> bytes:
        return self.raw[self.start + self.offsets[k]:self.start + self.offsets[k + 1]].tobytes()

    def find(self, keys: list[str], digests: np.ndarray) -> np.ndarray:
        """The place of each key's own string, or -1. Runs of equal digests are walked to their end."""
        found = np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.digests, digests)
        left = np.arange(len(keys))
        while len(left):
            left = left[at[left] < len(self.digests)]
            left = left[self.digests[at[left]] == digests[left]]
            same = np.array([self.stored(at[k]) == keys[k].encode() for k in left], bool)
            found[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return found


@functools.lru_cache(maxsize=2)
def _mapped(path: str) -> Index:
    return Index(path)


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[tuple[str, int]]:
    """Every rule string that the URL could fit, with the length of its host."""
    while host:
        for n in lengths:
            if n > len(path):
                break
            yield host + path[:n], len(host)
        _, dot, host = host.partition(".")


def _probe(index: Index, hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
    rows, keys, ranks = [], [], []
    for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        for key, own in candidates(host, path, index.lengths):
            rows.append(row)
            keys.append(key)
            ranks.append((len(key) << 32) + own)
    rule, blocked = np.full(len(hosts), None, object), np.full(len(hosts), -1)
    if keys:
        found = index.find(keys, np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64))
        hits = np.flatnonzero(found >= 0)
        for k in hits[np.argsort(np.array(ranks)[hits], kind="stable")]:  # the longest is written last
            rule[rows[k]], blocked[rows[k]] = keys[k], index.blocks[found[k]]
    return pd.DataFrame({"rule": rule, "blocked": blocked})


def verdicts(urls: DataFrame, rules: DataFrame | list[tuple[str, str, str]], url: str = "url", default: str = ALLOW,
             max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to each row of ``urls``.

    ``rules`` has host, path and verdict (a DataFrame with these columns, or tuples); rows with a null are
    ignored. A URL that no rule fits gets a null rule and the ``default`` verdict. Null, empty and malformed
    URLs have an empty host, which no rule fits. Repeated rows are judged one by one; columns of ``urls``
    named like the new ones are replaced. An empty rule list or table of URLs is fine.
    """
    spark = urls.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = rules.select("host", "path", "verdict").dropna()
    host, path = host_and_path(F.col(url))
    parsed = with_struct(urls, F.struct(host.alias("host"), path.alias("path")), ["host", "path"])
    size = rules.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + _PER_RULE), F.lit(0)).alias("b")).first()["b"]
    if size <= max_index_bytes:
        return _by_index(spark, parsed, rules, default)
    return _by_join(parsed, rules, default)


@functools.lru_cache(maxsize=1)
def _folder() -> str:
    """Of the driver's index files: one for the process, as Spark knows a file that it hands out by its place."""
    return tempfile.mkdtemp(prefix="rules-")


def _by_index(spark: SparkSession, parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    path = build_index(((r.host, r.path, r.verdict) for r in rules.toLocalIterator()), _folder())
    spark.sparkContext.addFile(path)  # fetched once by each executor, which maps its own copy
    name = os.path.basename(path)

    @F.pandas_udf("rule string, blocked int")
    def probe(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        return _probe(_mapped(SparkFiles.get(name)), hosts, paths)

    found = with_struct(parsed, probe("host", "path"), ["rule", "blocked"])
    verdict = F.when(F.col("blocked") == 1, BLOCK).when(F.col("blocked") == 0, ALLOW).otherwise(default)
    return with_struct(found, F.struct(verdict.alias("verdict")), ["verdict"]).drop("blocked")


def _by_join(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """For rule tables that no single machine should hold: an equi-join of candidate strings and rules."""
    key = F.concat("host", "path")
    rules = rules.groupBy(key.alias("rule")).agg(F.max(F.when(F.col("verdict") == BLOCK, 1).otherwise(0)).alias("blocked"))
    lengths = sorted(r["n"] for r in rules.select(F.length(F.regexp_extract("rule", "/.*$", 0)).alias("n")).distinct().collect())

    @F.pandas_udf("array<struct<rule:string,own:int>>")
    def fits(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([[{"rule": k, "own": n} for k, n in candidates(h, p, lengths)] for h, p in zip(hosts, paths, strict=True)])

    distinct = parsed.select("host", "path").distinct().filter("host <> ''")
    best = (distinct.select("host", "path", F.explode(fits("host", "path")).alias("c")).select("host", "path", "c.rule", "c.own")
            .join(rules, "rule").groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "own", "rule", "blocked")).alias("b")))
    old = [c for c in parsed.columns if c.lower() not in ("rule", "verdict")]
    verdict = F.when(F.col("b.blocked") == 1, BLOCK).when(F.col("b.blocked") == 0, ALLOW).otherwise(default)
    return (parsed.select(*old).join(best, ["host", "path"], "left")
            .select(*old, F.col("b.rule").alias("rule"), verdict.alias("verdict")))
