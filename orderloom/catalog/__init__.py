"""Registered queries over the test tables, each with its DuckDB counterpart."""

from __future__ import annotations

from importlib import import_module

MODULES = ("loads", "cleaning", "history", "star", "marts", "warehouse", "profiles", "crawls", "reports", "streams")


def all_queries() -> tuple[dict, dict]:
    """(queries, oracle SQL) of all modules."""
    from orderloom.catalog import registry

    for name in MODULES:
        import_module(f"orderloom.catalog.{name}")
    return registry.QUERIES, registry.ORACLE
