"""Queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

for _module in ("texts", "rows", "merges", "relations", "summaries", "listings", "stores", "flows"):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
