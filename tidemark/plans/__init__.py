"""Registered queries with their SQL twins, and the mapping of the given tables to panel inputs."""

from __future__ import annotations

import importlib

#: Modules that register queries.
MODULES = ("core", "features", "models", "vintages", "catalogs", "scans", "checks", "sources")


def _registry():
    from tidemark.plans import registry

    for m in MODULES:
        importlib.import_module(f"tidemark.plans.{m}")
    return registry


def all_queries() -> dict:
    return dict(_registry().QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_registry().SQL)
