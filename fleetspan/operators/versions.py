"""Settings that change: versions of a key, and the version that held at a row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.operators.report import last_wins
from fleetspan.operators.skew import DEFAULT_POLICY, HotKeyPolicy, with_last_known, with_previous


def versions_of(
    readings: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], values: Sequence[str], policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Versions (keys..., values..., valid_from) of settings that were read again and again.

    Of readings with the same key and time the last by ``tie`` counts. A reading
    with the values of the one before opens no version. Readings without a time are left out.
    """
    once = last_wins(readings.filter(F.col(ts).isNotNull()), [*keys, ts], list(tie), list(values))
    packed = once.withColumn("_values", F.struct(*values))
    rows = with_previous(packed, keys, [ts], {"_before": ("_values", None)}, policy)
    return rows.filter(F.col("_before").isNull() | ~F.col("_values").eqNullSafe(F.col("_before"))).select(
        *keys, *values, F.col(ts).alias("valid_from")
    )


def valid_to(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``valid_to``: when the next version of the key begins; null for the one that still holds."""
    return versions.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from")))


def as_of_join(
    rows: DataFrame, versions: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows with the values of the last version that began at or before their time, or nulls.

    ``versions`` has keys, values and ``valid_from``. Both sides are put in one
    order per key and the last version is handed on to the rows behind it, so
    there are no pairs of rows and versions, and a key with a third of all rows
    is cut into segments like any other ordered work. Null is a key; a row without a time has no version.
    """
    kept = [c for c in rows.columns if c not in values]
    asked = rows.select(F.struct(*kept).alias("_row"), *keys, F.col(ts).alias("_at"), F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_n"))
    known = versions.select(*keys, F.col("valid_from").alias("_at"), F.lit(0).alias("_side"), F.struct(*values).alias("_version"))
    both = asked.unionByName(known, allowMissingColumns=True).filter((F.col("_side") == 1) | F.col("_at").isNotNull())
    # A version that begins at a row's time holds for it. The order of rows among themselves does not matter.
    order = ["_at", "_side", "_n"]
    found = with_last_known(both, keys, order, {"_last": ("_version", F.col("_side") == 0)}, policy).filter(F.col("_side") == 1)
    return found.select("_row.*", *[F.col("_last")[v].alias(v) for v in values])
