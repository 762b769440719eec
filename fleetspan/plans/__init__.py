"""Registered queries over the given tables, each with its SQL twin."""

from __future__ import annotations

from importlib import import_module

MODULES = ["extraction", "reports", "states", "series", "network", "resources", "streams", "captured"]


def load_all():
    """The registry with the queries of every module."""
    for name in MODULES:
        import_module(f"fleetspan.plans.{name}")
    from fleetspan.plans.registry import REGISTRY

    return REGISTRY
