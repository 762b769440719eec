"""Counters: rates and ratios between samples, running totals, schedule sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.operators.report import last_wins
from fleetspan.operators.skew import DEFAULT_POLICY, HotKeyPolicy, with_previous, with_running_sum


def one_per_time(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One sample per key and time: copies are merged before anything is ordered."""
    return last_wins(df, [*keys, ts], list(tie), list(values))


def delta_ratio(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    hits: str,
    misses: str,
    out: str = "ratio",
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Hits over hits plus misses since the last sample; the first sample counts from 0.

    Of samples with the same key and time only the largest counts, as in a stream. No value where nothing was counted, or where a counter went back.
    """
    zero = F.lit(0).cast("bigint")
    samples = one_per_time(df, keys, ts, [hits, misses], [hits, misses])
    rows = with_previous(samples, keys, [ts], {"_hits": (hits, zero), "_misses": (misses, zero)}, policy, counted=df)
    return _ratio(rows, hits, misses, out)


def _ratio(rows: DataFrame, hits: str, misses: str, out: str) -> DataFrame:
    hit, miss = F.col(hits) - F.col("_hits"), F.col(misses) - F.col("_misses")
    value = F.when((hit >= 0) & (miss >= 0) & (hit + miss > 0), hit / (hit + miss))
    return rows.withColumn(out, value).drop("_hits", "_misses").filter(F.col(out).isNotNull())


def counter_rate(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    on_reset: str = "value",
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add ``delta`` and ``rate`` per second since the previous sample of the key.

    Of samples with the same key and time only the largest counts. After a reset the counter itself is the delta, or null with ``on_reset="null"``.
    """
    if on_reset not in ("value", "null"):
        raise ValueError(f"unknown reset rule {on_reset}")
    samples = one_per_time(df, keys, ts, [value], [value])
    rows = with_previous(samples, keys, [ts], {"_value": (value, None), "_ts": (ts, None)}, policy, counted=df)
    step = F.col(value) - F.col("_value")
    reset = F.col(value) if on_reset == "value" else F.lit(None)
    seconds = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_ts").cast("timestamp"))) / 1e6
    return (
        rows.withColumn("delta", F.when(step >= 0, step).when(step < 0, reset))
        .withColumn("rate", F.try_divide(F.col("delta").cast("double"), seconds))
        .drop("_value", "_ts")
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counted: Column,
    out: str = "total",
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add the number of counted rows so far, per key."""
    return with_running_sum(df, keys, order, {out: F.when(counted, 1).otherwise(0).cast("bigint")}, policy)


def schedule_sample(
    df: DataFrame,
    intervals: DataFrame,
    resource: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    tie: Sequence[str] = (),
) -> DataFrame:
    """One value per resource, metric and collection interval: the last one in it.

    ``intervals`` has (metric, interval_ms); ``bucket_ms`` is the interval's start.
    """
    ms = F.unix_millis(F.col(ts).cast("timestamp"))
    rows = df.join(intervals, "metric").withColumn("bucket_ms", F.floor(ms / F.col("interval_ms")) * F.col("interval_ms"))
    return last_wins(rows, [*resource, "metric", "bucket_ms"], [ts, *tie], [value])


def totals(df: DataFrame, keys: Sequence[str], **counted: Column) -> DataFrame:
    """Counts of the rows that meet each condition, per key."""
    aggs = [F.count_if(c).alias(name) for name, c in counted.items()]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
