"""What the operators of this subpackage share: registration, folds, settings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetspan
from fleetspan.session import materialize, prepare

# Functions that run in tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(fleetspan)

#: Rows that go to a Python worker at once: whole texts, so few of them.
ARROW_ROWS = "1000"

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function (spark, folder) -> DataFrame under its own name."""

    def register(build: Run) -> Run:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(session(spark), sf_dir.rstrip("/"))

        REGISTRY[build.__name__] = Query(build.__name__, run, sql)
        return run

    return register


def session(spark: SparkSession) -> SparkSession:
    """The library's settings, and small Arrow batches."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Numbers of documents without an id begin here, above all ids of tables.
UNNAMED = 1 << 62


def whole_rows(docs: DataFrame, *needed: str, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` as a struct ``_row`` of all columns (but ``without``) beside the ``needed`` ones.

    Stages work on these, and give ``_row.*`` back: so columns of any name, dots
    included, pass through untouched, and no column of a stage clashes with them.
    """
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    return docs.select(F.struct(*[quoted(c) for c in docs.columns if c not in without]).alias("_row"), *map(quoted, needed))


def with_ids(rows: DataFrame, label: str) -> DataFrame:
    """Rows of which those without a ``doc_id`` have a number of their own; written, if there are any, so that it stays."""
    missing = F.col("doc_id").isNull()
    if not rows.where(missing).limit(1).count():
        return rows
    own = F.lit(UNNAMED) + F.monotonically_increasing_id()
    return materialize(rows.withColumn("doc_id", F.when(missing, own).otherwise(F.col("doc_id").cast("long"))), label)


def fold(key: str, folds: int, held: int) -> Column:
    """Whether crc32 of the key as text falls into the held-out fold; a null key is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == held, F.lit(False))
