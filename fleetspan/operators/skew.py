"""Ordered per-key operators that stay balanced when one key is huge.

A window partitioned by a key puts all rows of that key in one task. Here a
key above a row limit is cut into ordered segments by a range partitioning;
each segment is windowed on its own, and a small per-segment summary carries
the state over the cuts. The result is the same as that of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.session import materialize


@dataclass(frozen=True)
class HotKeyPolicy:
    """When a key counts as hot and how finely it is cut.

    ``min_rows``: rows one task may sort; every key above it is cut.
    ``skip_below_bytes``: an input that Spark estimates below this size is not
    counted. The estimate knows nothing of compression and of rows that a query
    makes of one row, so it is low: a hundred times as much still fits the sort
    of one task, which spills.
    """

    min_rows: int = 2_000_000
    skip_below_bytes: int = 4 << 20


DEFAULT_POLICY = HotKeyPolicy()


def estimated_bytes(df: DataFrame) -> int:
    """Size estimate the optimizer uses for its own broadcast decision."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(df: DataFrame, keys: Sequence[str], policy: HotKeyPolicy = DEFAULT_POLICY) -> DataFrame | None:
    """All keys above the limit with their row counts, written once, or None.

    One aggregation of the bare keys with map-side combine.
    """
    if estimated_bytes(df) < policy.skip_below_bytes:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > policy.min_rows)
    found = materialize(counts, "hot-keys")
    return found if found.limit(1).count() else None


@dataclass(frozen=True)
class Cut:
    """A frame whose hot keys are cut into ordered segments: counted, cut and written once.

    ``previous``, ``running_sum`` and ``last_known`` add columns and give a frame
    that is cut alike, so several of them share one cut. ``rows`` puts the frame
    together again.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cold: DataFrame
    hot: DataFrame | None

    @property
    def rows(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot.drop("_seg"))

    def _with(self, cold: DataFrame, hot: DataFrame | None) -> Cut:
        return replace(self, cold=cold, hot=hot)

    def previous(self, columns: dict[str, tuple[str, Column | None]]) -> Cut:
        """Add the previous row's values per key, as ``with_previous`` does."""
        sources = F.struct(*[F.col(src).alias(out) for out, (src, _) in columns.items()])

        def finish(rows: DataFrame) -> DataFrame:
            exprs = {
                out: (
                    F.col("_prev")[out]
                    if default is None
                    else F.when(F.col("_prev").isNull(), default).otherwise(F.col("_prev")[out])
                )
                for out, (_, default) in columns.items()
            }
            return rows.withColumns(exprs).drop("_prev")

        plain = Window.partitionBy(*self.keys).orderBy(*self.order)
        cold = finish(self.cold.withColumn("_prev", F.lag(sources).over(plain)))
        if self.hot is None:
            return self._with(cold, None)
        local = Window.partitionBy(*self.keys, "_seg").orderBy(*self.order)
        tails = self.hot.groupBy(*self.keys, "_seg").agg(F.max_by(sources, F.struct(*self.order)).alias("_tail"))
        carry = tails.select(
            *self.keys, "_seg", F.lag("_tail").over(Window.partitionBy(*self.keys).orderBy("_seg")).alias("_carry")
        )
        rows = self.hot.withColumns({"_local": F.lag(sources).over(local), "_first": F.row_number().over(local) == 1})
        joined = _carry_join(rows, carry, self.keys)
        spread = joined.withColumn("_prev", F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_local")))
        return self._with(cold, finish(spread.drop("_local", "_first", "_carry")))

    def running_sum(self, columns: dict[str, Column]) -> Cut:
        """Add running sums per key, as ``with_running_sum`` does."""
        addends = {f"_add_{out}": value for out, value in columns.items()}

        def running(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
            window = (
                Window.partitionBy(*parts).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            return rows.withColumns({out: F.sum(f"_add_{out}").over(window) for out in columns})

        cold = running(self.cold.withColumns(addends), self.keys).drop(*addends)
        if self.hot is None:
            return self._with(cold, None)
        hot = self.hot.withColumns(addends)
        totals = hot.groupBy(*self.keys, "_seg").agg(*[F.sum(a).alias(a) for a in addends])
        before = Window.partitionBy(*self.keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(
            *self.keys, "_seg", F.struct(*[F.sum(a).over(before).alias(a) for a in addends]).alias("_carry")
        )
        joined = _carry_join(running(hot, [*self.keys, "_seg"]), carry, self.keys)
        spread = joined.withColumns(
            {
                out: F.coalesce(
                    F.col(out) + F.col("_carry")[f"_add_{out}"], F.col(out), F.col("_carry")[f"_add_{out}"]
                )
                for out in columns
            }
        )
        return self._with(cold, spread.drop("_carry", *addends))

    def last_known(self, columns: dict[str, tuple[str, Column]]) -> Cut:
        """Add the value of the last row for which a condition holds, as ``with_last_known`` does."""
        marked = {f"_mark_{out}": F.when(cond, F.struct(F.col(src).alias("v"))) for out, (src, cond) in columns.items()}

        def last(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
            window = Window.partitionBy(*parts).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            return rows.withColumns({out: F.last(f"_mark_{out}", ignorenulls=True).over(window) for out in columns})

        def plain(rows: DataFrame) -> DataFrame:
            return rows.withColumns({out: F.col(out)["v"] for out in columns}).drop(*marked)

        cold = plain(last(self.cold.withColumns(marked), self.keys))
        if self.hot is None:
            return self._with(cold, None)
        hot = self.hot.withColumns(marked)
        tails = hot.groupBy(*self.keys, "_seg").agg(
            *[F.max_by(m, F.when(F.col(m).isNotNull(), F.struct(*self.order))).alias(m) for m in marked]
        )
        before = Window.partitionBy(*self.keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
        carry = tails.select(
            *self.keys, "_seg", F.struct(*[F.last(m, ignorenulls=True).over(before).alias(m) for m in marked]).alias("_carry")
        )
        joined = _carry_join(last(hot, [*self.keys, "_seg"]), carry, self.keys)
        spread = joined.withColumns({out: F.coalesce(F.col(out), F.col("_carry")[f"_mark_{out}"]) for out in columns})
        return self._with(cold, plain(spread.drop("_carry")))


def cut(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    policy: HotKeyPolicy = DEFAULT_POLICY,
    counted: DataFrame | None = None,
) -> Cut:
    """The frame with its hot keys cut into segments.

    ``order`` must name a unique order within a key. ``counted`` is a frame with
    the keys and at least as many rows a key that is cheaper to count, such as
    the one that ``df`` aggregates. Without a hot key nothing but the counts is
    read. Else the frame is computed once more, to be written: its normal keys as
    they lie, its hot ones by segment, and all that follows reads what was written.
    """
    hot = hot_keys(df if counted is None else counted, keys, policy)
    if hot is None:
        return Cut(tuple(keys), tuple(order), df, None)
    rows = hot.agg(F.sum("_rows")).first()[0]
    # Spark broadcasts the keys where they are few.
    marks = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(marks[f"_hot_{k}"]) for k in keys])
    marked = materialize(df.join(marks, same, "left").drop(*[f"_hot_{k}" for k in keys]), "marked")
    cold = marked.filter(F.col("_hot").isNull()).drop("_hot")
    segments = ceil(rows / policy.min_rows) + 1
    ranged = (
        marked.filter(F.col("_hot")).drop("_hot")
        .repartitionByRange(segments, *keys, *order)
        .withColumn("_seg", F.spark_partition_id())
    )
    # Written once, so that the cuts are the same for every later reader and retry.
    return Cut(tuple(keys), tuple(order), cold, materialize(ranged, "segments"))


def _carry_join(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = [*keys, "_seg"]
    right = carry.select(*[F.col(n).alias(f"_c_{n}") for n in names], "_carry")
    cond = reduce(lambda a, b: a & b, [rows[n].eqNullSafe(right[f"_c_{n}"]) for n in names])
    # One row per hot key and segment it touches: a row for min_rows rows, so it is small beside them.
    return rows.join(right, cond, "left").drop(*[f"_c_{n}" for n in names])


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, Column | None]],
    policy: HotKeyPolicy = DEFAULT_POLICY,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the previous row's values per key.

    ``columns`` maps an output name to (source column, default for the first
    row or None). ``order`` must name a unique order within a key.
    """
    return cut(df, keys, order, policy, counted).previous(columns).rows


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Column],
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add running sums per key, including the current row; ``columns`` maps output name to addend."""
    return cut(df, keys, order, policy).running_sum(columns).rows


def with_last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add the value of the last row, the current one included, for which a condition holds.

    ``columns`` maps an output name to (source column, condition). The value may
    be null. ``order`` must name a unique order among the rows that matter.
    """
    return cut(df, keys, order, policy).last_known(columns).rows


def with_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add the 1-based position of the row within its key."""
    return with_running_sum(df, keys, order, {out: F.lit(1).cast("bigint")}, policy)
