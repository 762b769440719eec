"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetspan.llm.common import session, table
from fleetspan.llm.jaccard import one_of_each
from fleetspan.llm.language import known_language
from fleetspan.llm.mixing import mixed
from fleetspan.llm.templates import without_leaks
from fleetspan.llm.toxicity import clean
from fleetspan.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Name and function of each stage: (spark, docs, folder of the tables) -> DataFrame.
STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("toxicity", clean),
    ("near_duplicates", one_of_each),
    ("decontamination", without_leaks),
    ("mixing", mixed),
]

#: Trained models and iterations: SQL can't express the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages keep, with their tokens and rates."""
    docs = table(session(spark), sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir.rstrip("/")), f"pipeline-{name}")
    return docs
