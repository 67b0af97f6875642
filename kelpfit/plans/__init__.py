"""Registered queries over the driver tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

MODULES = ("regression", "sampling", "preparation", "clustering", "neighbours", "trees",
           "neurons", "networks", "models")


def load():
    """All queries and all oracle statements, by name."""
    for module in MODULES:
        import_module(f"kelpfit.plans.{module}")
    from kelpfit.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
