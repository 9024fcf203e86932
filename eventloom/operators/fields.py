"""Column filters by rule: keep lists and drop lists, per app or for all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns no rule can remove. Fixed values.
SYSTEM_FIELDS = ["event_id", "event_name", "event_timestamp", "app_id", "user_pseudo_id", "platform"]
WHITELIST, BLACKLIST = "whitelist", "blacklist"


@dataclass(frozen=True)
class FieldRule:
    mode: str
    fields: tuple[str, ...] = ()

    def keeps(self, column: str) -> bool:
        listed = column in self.fields
        return column in SYSTEM_FIELDS or (listed if self.mode.lower() == WHITELIST else not listed)


def field_filter(df: DataFrame, rule: FieldRule | None) -> DataFrame:
    """Columns in input order."""
    return df if rule is None else df.select(*[c for c in df.columns if rule.keeps(c)])


def effective_rules(app_ids: list[str], app_rules: dict[str, FieldRule],
                    default: FieldRule | None = None) -> dict[str, FieldRule]:
    """The app's own rule, else the common one."""
    chosen = {a: app_rules.get(a, default) for a in app_ids}
    return {a: r for a, r in chosen.items() if r is not None}


def apply_field_rules(df: DataFrame, rules: dict[str, FieldRule], app_ids: list[str]) -> DataFrame:
    """Per-app rules in one projection: a column is nulled for the apps that drop it.

    `app_ids` are the apps of the data; one without a rule keeps all columns. A rule
    that all of them share removes columns outright, otherwise a dropped column
    stays and is null.
    """
    if not rules:
        return df
    if len(set(rules.values())) == 1 and set(app_ids) <= set(rules):
        return field_filter(df, next(iter(rules.values())))
    out = []
    for c in df.columns:
        hidden = [a for a, r in rules.items() if not r.keeps(c)]
        keep = F.col(c)
        out.append(F.when(F.col("app_id").isin(hidden), None).otherwise(keep).alias(c) if hidden else keep)
    return df.select(*out)
