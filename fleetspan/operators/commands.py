"""Metrics from captured command output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.coerce import to_numeric
from fleetspan.functions.extract import extract_regex
from fleetspan.functions.text import leading_integer_sum


def split_property(text: str) -> tuple[str, str]:
    """Arguments and pattern of a ``{args}|regex`` metric; ``{}`` stands for no arguments."""
    args, pattern = text.split("|", 1)
    return args.removeprefix("{").removesuffix("}"), pattern


def command_metrics(runs: DataFrame, metrics: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Rows (keep..., metric, value): each metric's pattern over the run with the metric's arguments."""
    def value(text: str):
        args, pattern = split_property(text)
        return F.when(F.coalesce("args", F.lit("")) == args, to_numeric(extract_regex(F.col("stdout"), pattern)))

    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), value(text).alias("value")) for name, text in metrics.items()])
    return (
        runs.select(*keep, F.explode(pairs).alias("_m"))
        .select(*keep, "_m.metric", "_m.value")
        .filter(F.col("value").isNotNull())
    )


def disk_usage(runs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows (keep..., bytes, elapsed_ms): sum of the sizes a finished run lists; runs without one are left out."""
    return (
        runs.filter(F.col("exit_code").isNotNull())
        .select(*keep, leading_integer_sum(F.col("stdout")).alias("bytes"), (F.col("elapsed_ns") / 1_000_000).alias("elapsed_ms"))
        .filter(F.col("bytes").isNotNull())
    )
