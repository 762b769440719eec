"""Operators for training-data pipelines, each with its query.

Nothing else in the library imports this subpackage. ``queries()`` and
``oracle_sql()`` list what the modules register.
"""

from __future__ import annotations

from importlib import import_module

#: In the order of the operators' numbers.
MODULES = [
    "mixing",
    "chat",
    "hmm",
    "toxicity",
    "fixity",
    "extraction",
    "posting",
    "language",
    "templates",
    "jaccard",
    "covertree",
    "spelling",
    "quality",
]


def load_all() -> dict:
    """The registry with the queries of every module."""
    for name in MODULES:
        import_module(f"fleetspan.llm.{name}")
    from fleetspan.llm.common import REGISTRY

    return REGISTRY


def queries() -> dict:
    """Every query: (spark, folder of the tables) -> DataFrame."""
    return {name: q.run for name, q in load_all().items()}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {name: q.sql for name, q in load_all().items() if q.sql}
