"""Every query by key, with the oracle SQL where there is one."""

from __future__ import annotations

import importlib

MODULES = ["metrics", "explore", "etl", "tables", "functions", "streams"]


def _collect(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"eventloom.catalog.{name}")
        for key, value in getattr(module, attribute).items():
            if key in out:
                raise ValueError(f"query {key} registered twice")
            out[key] = value
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracles() -> dict[str, str]:
    return _collect("ORACLES")
