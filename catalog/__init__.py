"""Registered queries: each applies a library operator to the given tables, next to an
independent SQL statement that must give the same rows."""

import importlib

from catalog.registry import ORACLES, QUERIES  # noqa: F401

MODULES = ["functions", "projections", "joins", "aggregates", "picks", "merges", "changes", "landing", "creatives", "sync", "gold", "streams"]


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
