"""Reports: requested metrics against collected values."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.coerce import to_numeric
from fleetspan.operators.digest import json_digest


def last_wins(df: DataFrame, keys: Sequence[str], position: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Of the rows with the same keys keep the values of the last position.

    An aggregation with map-side combine, so a hot key costs one row per task.
    """
    last = F.max_by(F.struct(*values), F.struct(*position)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col("_last")[v].alias(v) for v in values])


def report(
    definitions: DataFrame, values: DataFrame, *fallbacks: DataFrame, resource: Sequence[str] = ("resource_key",)
) -> DataFrame:
    """Requested metric joined with its value; a metric nobody reports is dropped.

    ``values`` and each fallback have (resource..., metric, value). A fallback
    serves only what the sources before it do not have. ``definitions`` may
    hold resource columns too, to ask for different metrics per resource.
    """
    names = [c for c in definitions.columns if c in (*resource, "metric")]
    if not fallbacks:
        return values.filter(F.col("value").isNotNull()).join(definitions, names)
    ranked = [
        s.select(*resource, "metric", "value", F.lit(rank).alias("_rank"))
        for rank, s in enumerate((values, *fallbacks))
    ]
    wanted = reduce(DataFrame.unionByName, ranked).filter(F.col("value").isNotNull()).join(definitions, names)
    extra = [c for c in definitions.columns if c not in (*resource, "metric")]
    return wanted.groupBy(*resource, "metric", *extra).agg(F.min_by("value", "_rank").alias("value"))


def unserved(requests: DataFrame, served: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requests that no earlier source answered."""
    return requests.join(served.select(*keys).distinct(), list(keys), "left_anti")


def coerce(values: DataFrame, definitions: DataFrame, on: Sequence[str] = ("metric",)) -> DataFrame:
    """Typed values: a measurement becomes a double, a trait trimmed text, any other type an error.

    A measurement that is no number is dropped.
    """
    raw = F.col("value")
    kind = F.col("data_type")
    return (
        values.join(definitions, list(on))
        .withColumn("dvalue", F.when(kind == "measurement", to_numeric(raw)))
        .withColumn("svalue", F.when(kind == "trait", F.trim(raw)))
        .withColumn(
            "error", F.when(~kind.isin("measurement", "trait"), F.concat(F.lit("unsupported type "), kind))
        )
        .filter(F.coalesce(F.col("dvalue").cast("string"), F.col("svalue"), F.col("error")).isNotNull())
        .drop("value")
    )


def report_map(df: DataFrame, resource: Sequence[str], metrics: Sequence[str], value: str = "value") -> DataFrame:
    """One MAP(metric -> value) per resource over the given metric names.

    One aggregate per metric instead of a collected list: the state per
    resource is bounded by the number of names.
    """
    wide = df.filter(F.col("metric").isin(*metrics)).groupBy(*resource).agg(
        *[F.max(F.when(F.col("metric") == m, F.col(value))).alias(f"_m{i}") for i, m in enumerate(metrics)]
    )
    pairs = [x for i, m in enumerate(metrics) for x in (F.lit(m), F.col(f"_m{i}"))]
    return wide.select(*resource, F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("report"))


def contract(
    definitions: DataFrame,
    reported: DataFrame,
    resource_type: str = "resource_type",
    resource: str = "resource_key",
    inventory: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(declared but not reported, reported but not declared), both per resource.

    ``inventory`` has the resources that should report; one that is silent
    misses all its type declares. Without it the reporting resources are taken.
    The metrics a resource reports are collected only as far as they are
    declared, so the state per resource is bounded by its type's definitions.
    """
    declared = definitions.select(resource_type, "metric").distinct()
    flagged = reported.select(resource_type, resource, "metric").join(
        declared.withColumn("_declared", F.lit(True)), [resource_type, "metric"], "left"
    )
    seen = flagged.select(resource_type, resource, F.when(F.col("_declared"), F.col("metric")).alias("metric"))
    if inventory is not None:
        seen = seen.unionByName(inventory.select(resource_type, resource, F.lit(None).cast("string").alias("metric")))
    have = seen.groupBy(resource_type, resource).agg(F.collect_set("metric").alias("_have"))
    wanted = declared.groupBy(resource_type).agg(F.collect_set("metric").alias("_wanted"))
    missing = have.join(wanted, resource_type).select(
        resource_type, resource, F.explode(F.array_except("_wanted", "_have")).alias("metric")
    )
    unexpected = flagged.filter(F.col("_declared").isNull()).select(resource_type, resource, "metric").distinct()
    return missing, unexpected


def missing_settings(df: DataFrame, settings: str, required: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Required settings that are absent or empty, one row each."""
    lacking = F.filter(
        F.array(*[F.lit(r) for r in required]),
        lambda r: F.coalesce(F.try_element_at(F.col(settings), r), F.lit("")) == "",
    )
    return df.select(*keep, F.explode(lacking).alias("setting"))


def with_digest_hook(values: DataFrame, *hooks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Values plus what each hook derives from them, before they are reported."""
    return reduce(DataFrame.unionByName, [hook(values) for hook in hooks], values)


def json_valued_attributes(metrics: Sequence[str], keep: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Hook: digest the attributes whose value is itself a JSON document."""
    def hook(values: DataFrame) -> DataFrame:
        documents = values.filter(F.col("metric").isin(*metrics))
        return json_digest(documents, "value", [*keep]).select(*keep, F.col("key").alias("metric"), "value")

    return hook


def union_by_key(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union in which the first part that has a key wins."""
    ranked = [p.withColumn("_rank", F.lit(i)) for i, p in enumerate(parts)]
    rest = [c for c in parts[0].columns if c not in keys]
    everything = reduce(DataFrame.unionByName, ranked)
    first = F.min_by(F.struct(*rest), F.struct("_rank", *[c for c in rest if _orderable(parts[0], c)])).alias("_first")
    return everything.groupBy(*keys).agg(first).select(*keys, *[F.col("_first")[c].alias(c) for c in rest])


def _orderable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def ranked_lookup(names: DataFrame, resources: DataFrame, columns: Sequence[str] = ("name", "type", "key")) -> DataFrame:
    """For each wanted ``wanted`` name the resource with that name, else type, else key.

    ``resources`` must have the lookup columns; ties go to the smallest key.
    """
    tries = [
        resources.select(
            F.col(c).alias("wanted"), F.lit(rank).alias("_rank"), *[F.col(x).alias(x) for x in ("key", "name", "type")]
        )
        for rank, c in enumerate(columns)
    ]
    best = (
        reduce(DataFrame.unionByName, tries)
        .join(names.select("wanted").distinct(), "wanted", "left_semi")
        .groupBy("wanted")
        .agg(F.min(F.struct("_rank", "key", "name", "type")).alias("_best"))
    )
    return best.select(
        "wanted",
        F.col("_best._rank").alias("rank"),
        F.col("_best.key").alias("key"),
        F.col("_best.name").alias("name"),
        F.col("_best.type").alias("type"),
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def present(column: Column) -> Column:
    """Neither null nor empty."""
    return column.isNotNull() & (column.cast("string") != "")
