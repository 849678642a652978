"""Query catalogue."""

from __future__ import annotations

from importlib import import_module

from tidepool.plans.registry import REGISTRY, Query

MODULES = ("relational", "expressions", "temporal", "measures", "lake_jobs", "patterns", "iterative", "streams", "rows")


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"tidepool.plans.{module}")
    return dict(REGISTRY)
