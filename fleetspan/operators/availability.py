"""Availability: predicates on captured responses, states, exit codes and probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States that count as up.
RUNNING_STATES = ("RUNNING",)
ACTIVE_STATES = ("ACTIVE",)
JOB_UP_STATES = ("PREMATER", "PREP", "RUNNING", "SUCCEEDED")
UP_EXIT_CODES = (0, 1)
STANDBY_ERROR = "StandbyException"


def status_accepted(code: Column, expected: Column | None = None) -> Column:
    """An expected code must be met; without one any code passes."""
    if expected is None:
        return F.lit(True)
    return expected.isNull() | F.coalesce(code == expected, F.lit(False))


def body_accepted(body: Column, pattern: str | None = None) -> Column:
    """The pattern is found in the body; an empty pattern passes."""
    return F.lit(True) if not pattern else F.coalesce(body.rlike(pattern), F.lit(False))


def response_up(code: Column, body: Column, expected: Column | None = None, pattern: str | None = None) -> Column:
    """A response arrived, with the expected status and a body the pattern accepts."""
    return code.isNotNull() & status_accepted(code, expected) & body_accepted(body, pattern)


def response_reason(code: Column, body: Column, expected: Column | None = None, pattern: str | None = None) -> Column:
    """Why a response counts as down; null when it is up."""
    return (
        F.when(code.isNull(), "no response")
        .when(~status_accepted(code, expected), F.concat(F.lit("status "), code.cast("string")))
        .when(~body_accepted(body, pattern), "body not matched")
    )


def state_up(state: Column, states: Sequence[str]) -> Column:
    return F.coalesce(state.isin(*states), F.lit(False))


def exit_up(code: Column) -> Column:
    return F.coalesce(code.isin(*UP_EXIT_CODES), F.lit(False))


def answered(value: Column) -> Column:
    """The probe, statistics call, path or query gave an answer."""
    return value.isNotNull()


def file_system_up(answer: Column, error: Column) -> Column:
    """The file system answers; a standby node that refuses counts as up."""
    return answer.isNotNull() | F.coalesce(F.instr(error, STANDBY_ERROR) > 0, F.lit(False))


def enabled(flag: Column) -> Column:
    """Enabled unless told otherwise."""
    return F.lower(F.coalesce(flag, F.lit("true"))) == "true"


def availability(df: DataFrame, up: Column, keys: Sequence[str] = ("resource_key", "ts"), reason: Column | None = None) -> DataFrame:
    """Rows (keys..., up, reason) of a per-row predicate."""
    return df.select(*keys, up.alias("up"), (F.lit(None).cast("string") if reason is None else reason).alias("reason"))


def all_up(df: DataFrame, keys: Sequence[str], up: Column) -> DataFrame:
    """Per key: up only when every row is, with the number of rows that are."""
    return df.groupBy(*keys).agg(F.bool_and(up).alias("up"), F.count_if(up).alias("answers"))


def any_up(df: DataFrame, keys: Sequence[str], up: Column) -> DataFrame:
    """Per key: up when any row is."""
    return df.groupBy(*keys).agg(F.bool_or(up).alias("up"))


def still_listed(children: DataFrame, listing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Children with ``up`` true where they are in the latest listing."""
    seen = listing.select(*on).distinct().withColumn("_seen", F.lit(True))
    return children.join(seen, list(on), "left").withColumn("up", F.col("_seen").isNotNull()).drop("_seen")


def latched_up(df: DataFrame, keys: Sequence[str], order: str, good: Column) -> DataFrame:
    """Up from the first good row of a key on: a first time per key instead of a running window."""
    first = df.filter(good).groupBy(*keys).agg(F.min(order).alias("_since"))
    return (
        df.join(first, list(keys), "left")
        .withColumn("up", F.col("_since").isNotNull() & (F.col(order) >= F.col("_since")))
        .drop("_since")
    )


def first_readable(readings: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Per key: up when its first reading is no exception."""
    return readings.groupBy(*keys).agg((~F.min_by("is_exception", position)).alias("up"))
