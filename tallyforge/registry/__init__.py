"""Queries over the benchmark tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from tallyforge.registry import (
    aggregate_queries,
    join_queries,
    model_queries,
    profile_queries,
    projection_queries,
    quality_queries,
    ranking_queries,
    report_queries,
    source_queries,
)
from tallyforge.registry.catalog import Entry

_MODULES = (
    source_queries,
    projection_queries,
    quality_queries,
    join_queries,
    aggregate_queries,
    ranking_queries,
    profile_queries,
    report_queries,
    model_queries,
)


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for module in _MODULES:
        for name, entry in module.catalog.entries.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
