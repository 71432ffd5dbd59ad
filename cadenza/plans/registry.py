"""All registered driver-table queries and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = ["scoring", "lyrics", "matching", "gating", "framestats", "answers", "enrichment", "streams", "files"]


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in _MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        out.update(getattr(mod, attr, {}))
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLE")
