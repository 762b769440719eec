"""Groups of like-named instances."""

from __future__ import annotations

from collections.abc import Sequence
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.operators.skew import DEFAULT_POLICY, HotKeyPolicy, with_row_number

# Fixed value: an instance name and its number.
INSTANCE = r"^(.*?)(-[\d\-]+)$"


def group_name(name: Column, pattern: str = INSTANCE) -> Column:
    """``sink-1`` as ``sink*``; null for a name without a number."""
    return F.when(name.rlike(pattern), F.concat(F.regexp_extract(name, pattern, 1), F.lit("*")))


def group_sum(df: DataFrame, name: Column, attribute: str = "attribute", value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Per group and attribute: sum of the members' numeric values and their number."""
    number = F.col(value).try_cast("double")
    return (
        df.select(*keep, name.alias("group_name"), attribute, number.alias("_n"))
        .filter(F.col("group_name").isNotNull() & F.col("_n").isNotNull())
        .groupBy(*keep, "group_name", attribute)
        .agg(F.sum("_n").alias("value"), F.count(F.lit(1)).alias("members"))
    )


def instance_keys(
    df: DataFrame, name: str, order: Column, keep: Sequence[str] = (), out: str = "instance_key", policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add ``name|n``: n counts the rows of a name from 0 in the text order of their ids."""
    ordered = df.withColumn("_order", order.cast("string"))
    numbered = with_row_number(ordered, [*keep, name], ["_order"], "_n", policy)
    return numbered.withColumn(out, F.concat(F.col(name), F.lit("|"), (F.col("_n") - 1).cast("string"))).drop("_n", "_order")


def matching_beans(attributes: DataFrame, pattern: str) -> DataFrame:
    """Attributes of beans whose name fits a pattern with ``*`` and ``%variable%`` wildcards."""
    parts = re.split(r"\*|%\w+%", pattern)
    return attributes.filter(F.col("bean").rlike("^" + ".*".join(re.escape(p) for p in parts) + "$"))
