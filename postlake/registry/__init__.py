"""Registered queries over the test tables, each with the SQL its result must equal."""

from __future__ import annotations

import importlib

from postlake.registry.base import ORACLES, QUERIES

for _area in (
    "sources", "records", "tables", "search", "scalars", "media", "dictionary", "sinks", "streams",
):
    importlib.import_module(f"postlake.registry.{_area}")

__all__ = ["ORACLES", "QUERIES"]
