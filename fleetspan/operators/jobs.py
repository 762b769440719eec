"""Job runs: latest and prior run, recency, status totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.functions.coerce import elapsed_ms, epoch_ms, recency_ms
from fleetspan.operators.availability import JOB_UP_STATES, state_up

SUCCEEDED = "SUCCEEDED"


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, out: str = "rank") -> DataFrame:
    """The ``n`` newest rows of each key, ranked from 1.

    Spark cuts each key to ``n`` rows before the shuffle, so a hot key sends little.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= n)


def newest_overall(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows of all."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def latest_and_prior(runs: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per job: columns of the newest run and, as ``prior_...``, of the one before.

    The two newest runs leave each task through a per-key limit; no key is ever sorted whole after the shuffle.
    """
    two = newest(runs, keys, order, 2, "_rank")
    pick = F.struct(*columns)
    return (
        two.groupBy(*keys)
        .agg(
            F.max(F.when(F.col("_rank") == 1, pick)).alias("_latest"),
            F.max(F.when(F.col("_rank") == 2, pick)).alias("_prior"),
        )
        .select(
            *keys,
            *[F.col("_latest")[c].alias(c) for c in columns],
            *[F.col("_prior")[c].alias(f"prior_{c}") for c in columns],
        )
    )


def job_status(
    runs: DataFrame, as_of: Column, keys: Sequence[str] = ("app_name",), order: Sequence[str] = ("created_time", "run_id")
) -> DataFrame:
    """Per job: status and elapsed time of the newest run, time since the last success, prior status.

    ``runs`` has run_id, status, created_time and end_time. ``as_of`` stands for now.
    """
    heads = latest_and_prior(runs, keys, order, ["run_id", "status", "created_time", "end_time"])
    success = (
        runs.filter((F.col("status") == SUCCEEDED) & F.col("end_time").isNotNull())
        .groupBy(*keys)
        .agg(F.max("end_time").alias("_success"))
    )
    return (
        heads.join(success, list(keys), "left")
        .withColumns(
            {
                "elapsed_ms": elapsed_ms(F.col("created_time"), F.col("end_time"), as_of),
                "recency_ms": recency_ms(F.col("_success"), as_of),
                "up": state_up(F.col("status"), JOB_UP_STATES),
            }
        )
        .drop("_success")
    )


def coordinator_times(df: DataFrame, as_of: Column, start: str = "start_time", action: str = "last_action") -> DataFrame:
    """Add time since the start, time until the next action and time since the last one."""
    until = epoch_ms(F.col(action)) - epoch_ms(as_of)
    return df.withColumns(
        {"start_elapsed_ms": recency_ms(F.col(start), as_of), "action_elapsed_ms": until, "last_action_recency_ms": -until}
    )


def status_totals(df: DataFrame, status: str = "status", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, status).agg(F.count(F.lit(1)).alias("runs"))
