"""Streaming jobs over micro-batches.

Each job runs the batch operator on a micro-batch and writes the result under
its epoch number, so a batch that is run again overwrites itself. Jobs with
state keep one row per key beside the output: every batch writes the rows it
touched, and every so often they are merged into a whole table. State lies in
folders by a hash of its key, and a batch reads those of its own keys only. Null
is a key. State and scratch folders are used in turn, so they do not pile up,
and a batch that is run again finds what it found before.
A key with a third of the rows is handled by the batch operator's own
segmentation, never by one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from fleetspan.operators.config import CHILD_STATE, children_state, refreshed_children
from fleetspan.operators.counters import one_per_time
from fleetspan.operators.events import EXIT_SEVERITY, exit_severity
from fleetspan.operators.joins import null_safe_join
from fleetspan.operators.report import last_wins
from fleetspan.operators.skew import DEFAULT_POLICY, HotKeyPolicy, with_previous
from fleetspan.operators.versions import as_of_join
from fleetspan.session import materialize, prepare


def read_stream(spark: SparkSession, path: str, ddl_or_schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A file stream; the path may be a glob."""
    reader = spark.readStream.format(fmt).schema(ddl_or_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


@dataclass(frozen=True)
class Place:
    """Folder of a job: ``out`` for results, ``state`` for state, ``checkpoint`` for progress."""

    root: str

    def out(self, epoch: int | None = None) -> str:
        return f"{self.root}/out" if epoch is None else f"{self.root}/out/epoch={epoch}"

    def delta(self, epoch: int, every: int) -> str:
        return f"{self.root}/state/delta{epoch % (2 * every)}"

    def whole(self, number: int) -> str:
        return f"{self.root}/state/whole{number % 2}"

    def pending(self, epoch: int) -> str:
        return f"{self.root}/pending/slot{epoch % 2}"

    def mark(self, epoch: int) -> str:
        return f"{self.root}/mark/slot{epoch % 2}"

    def late(self, epoch: int | None = None) -> str:
        return f"{self.root}/late" if epoch is None else f"{self.root}/late/epoch={epoch}"

    @property
    def rhythm(self) -> str:
        return f"{self.root}/state/rhythm"

    def scratch(self, epoch: int, label: str) -> str:
        return f"{self.root}/scratch/slot{epoch % 2}/{label}"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def start(
    stream: DataFrame, place: Place, batch: Callable[[DataFrame, int], None], every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Run ``batch`` on each micro-batch: once over what is there, or at a fixed interval."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", place.checkpoint).foreachBatch(batch)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_stateless(stream: DataFrame, place: Place, transform: Callable[[DataFrame], DataFrame], every: str | None = None) -> StreamingQuery:
    """Apply a batch transformation to each micro-batch."""
    def batch(rows: DataFrame, epoch: int) -> None:
        prepare(rows.sparkSession)
        transform(rows).write.mode("overwrite").parquet(place.out(epoch))

    return start(stream, place, batch, every)


BUCKET = "_bucket"


def _bucket(by: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def _write_state(rows: DataFrame, path: str, by: Sequence[str], buckets: int) -> None:
    """State rows in a folder per bucket; one row a key, so buckets are even."""
    held = rows.withColumn(BUCKET, _bucket(by, buckets))
    held.repartition(buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def _state_parts(spark: SparkSession, place: Place, epoch: int, state_ddl: str, merge_every: int) -> list[tuple[int, DataFrame]]:
    """The last whole table and the rows touched since, by age."""
    whole = epoch // merge_every
    folders = [(-1, place.whole(whole))] if whole else []
    folders += [(e, place.delta(e, merge_every)) for e in range(whole * merge_every, epoch)]
    schema = StructType([*StructType.fromDDL(state_ddl).fields, StructField(BUCKET, IntegerType())])
    return [(age, spark.read.schema(schema).parquet(folder)) for age, folder in folders]


def read_state(
    spark: SparkSession,
    place: Place,
    epoch: int,
    keys: Sequence[str],
    state_ddl: str,
    merge_every: int,
    only: DataFrame | None = None,
    buckets: Sequence[int] | None = None,
) -> DataFrame:
    """State as it is before ``epoch``, of the keys in ``only`` or of all.

    The wanted buckets are read, cut down to the wanted keys, and then the
    newest row of each key counts.
    """
    parts = []
    for age, part in _state_parts(spark, place, epoch, state_ddl, merge_every):
        if buckets is not None:
            part = part.filter(F.col(BUCKET).isin(list(buckets)))
        part = part.drop(BUCKET)
        if only is not None:
            part = null_safe_join(part, only, only.columns, "left_semi")
        parts.append(part.withColumn("_age", F.lit(age)))
    if not parts:
        return spark.createDataFrame([], state_ddl)
    columns = [c for c in parts[0].columns if c != "_age"]
    rest = [c for c in columns if c not in keys]
    newest = last_wins(reduce(DataFrame.unionByName, parts), keys, ["_age"], rest) if len(parts) > 1 else parts[0]
    return newest.select(*columns)


@dataclass(frozen=True)
class Stateful:
    """A step with state: ``step(rows, state) -> (results, touched state)``.

    With ``ts`` rows are handed to the step in event time: they wait until a row
    that is ``delay_seconds`` newer has come, so files may come out of order by
    that much. A row that comes later still goes to the side output ``late``,
    where it can be counted; it never changes the state. Rows without a time
    don't wait, and come before the others of their batch.

    Where the state follows from the results, ``from_results`` makes it of what
    was written, so that a step is not computed twice.

    ``keys`` name a row of the state, ``by`` (the keys, if not given) are the
    columns that it shares with the rows; state lies in ``buckets`` by their hash.
    """

    keys: Sequence[str]
    state_ddl: str
    step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame | None]]
    ts: str | None = None
    delay_seconds: int = 600
    merge_every: int = 16
    by: Sequence[str] | None = None
    from_results: Callable[[DataFrame], DataFrame] | None = None
    buckets: int = 64

    @property
    def shared(self) -> list[str]:
        return list(self.by or self.keys)

    def ready(self, spark: SparkSession, place: Place, rows: DataFrame, epoch: int) -> DataFrame:
        """The rows, old and new, that the watermark has passed; the others are kept for the next batch."""
        if self.ts is None:
            # Results and state are both computed from these rows, so they are fixed first.
            return materialize(rows, "rows", place.scratch(epoch, "rows"), spark)
        time = F.unix_micros(F.col(self.ts).cast("timestamp"))
        before = spark.read.parquet(place.mark(epoch - 1)).first()["newest"] if epoch else None
        delay = self.delay_seconds * 1_000_000
        passed = F.lit(False) if before is None else F.coalesce(time <= before - delay, F.lit(False))
        # The batch's files are read for their times, and once more to be written.
        seen = rows.agg(F.max(time).alias("newest"), F.count_if(passed).alias("late")).first()
        newest = max((n for n in (before, seen["newest"]) if n is not None), default=None)
        if seen["late"]:
            rows.filter(passed).write.mode("overwrite").parquet(place.late(epoch))
        live = rows.filter(~passed)
        if epoch:
            live = live.unionByName(self.waiting(spark, place, rows.schema, epoch - 1))
        waits = F.lit(False) if newest is None else F.coalesce(time > newest - delay, F.lit(False))
        live.withColumn("_waits", waits).write.mode("overwrite").partitionBy("_waits").parquet(place.pending(epoch))
        spark.createDataFrame([(epoch, newest)], "epoch BIGINT, newest BIGINT").write.mode("overwrite").parquet(place.mark(epoch))
        return self.waiting(spark, place, rows.schema, epoch, False)

    def waiting(self, spark: SparkSession, place: Place, schema, epoch: int, waits: bool = True) -> DataFrame:
        """Rows that wait after a batch, or those that did not have to."""
        split = StructType([*schema.fields, StructField("_waits", BooleanType())])
        return spark.read.schema(split).parquet(place.pending(epoch)).filter(F.col("_waits") == waits).drop("_waits")

    def work(self, spark: SparkSession, place: Place, fixed: DataFrame, epoch: int, layout: tuple[int, int]) -> None:
        """Run the step on rows that are fixed, and write results and state."""
        merge_every, buckets = layout
        wanted = fixed.select(*self.shared).distinct()
        # At most ``buckets`` numbers.
        touched = [r[0] for r in wanted.select(_bucket(self.shared, buckets)).distinct().collect()] if epoch else []
        old = read_state(spark, place, epoch, self.keys, self.state_ddl, merge_every, wanted, touched)
        found, news = self.step(fixed, old)
        found.write.mode("overwrite").parquet(place.out(epoch))
        if self.from_results:
            news = self.from_results(spark.read.schema(found.schema).parquet(place.out(epoch)))
        _write_state(news, place.delta(epoch, merge_every), self.shared, buckets)
        if (epoch + 1) % merge_every == 0:
            # The last whole table is read and the other one of the two is written.
            merged = read_state(spark, place, epoch, self.keys, self.state_ddl, merge_every)
            news = spark.read.schema(self.state_ddl).parquet(place.delta(epoch, merge_every)).drop(BUCKET)
            merged = null_safe_join(merged, news.select(*self.keys), self.keys, "left_anti").unionByName(news)
            _write_state(merged, place.whole((epoch + 1) // merge_every), self.shared, buckets)


def _layout(spark: SparkSession, place: Place, wanted: tuple[int, int]) -> tuple[int, int]:
    """Batches between merges, and buckets: what the job was first started with, as its folders are laid out by it."""
    try:
        kept = spark.read.schema("every INT, buckets INT").parquet(place.rhythm).first()
        return kept["every"], kept["buckets"]
    except AnalysisException:
        spark.createDataFrame([wanted], "every INT, buckets INT").write.parquet(place.rhythm)
        return wanted


def run_job(stream: DataFrame, place: Place, job: Stateful, every: str | None = None) -> StreamingQuery:
    """Apply a step with state to each micro-batch; see ``Stateful``.

    After every ``merge_every`` batches the touched rows are merged into a new
    whole table. With ``ts``, ``drain`` handles the rows that still wait when the
    stream has ended.
    """
    spark = stream.sparkSession
    layout = _layout(spark, place, (job.merge_every, job.buckets))

    def batch(rows: DataFrame, epoch: int) -> None:
        job.work(spark, place, job.ready(spark, place, rows, epoch), epoch, layout)

    return start(stream, place, batch, every)


def run_with_state(
    stream: DataFrame,
    place: Place,
    keys: Sequence[str],
    state_ddl: str,
    step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
    every: str | None = None,
    merge_every: int = 16,
    ts: str | None = None,
    delay_seconds: int = 600,
) -> StreamingQuery:
    """``run_job`` of a job made of these parts."""
    return run_job(stream, place, Stateful(keys, state_ddl, step, ts, delay_seconds, merge_every), every)


def drain(spark: SparkSession, place: Place, schema: StructType, job: Stateful) -> None:
    """Hand the rows that still wait to the step: the end of a replay, after which the job is not run again."""
    last = spark.read.schema("epoch BIGINT, newest BIGINT").parquet(f"{place.root}/mark/*").agg(F.max("epoch")).first()[0]
    if last is not None:
        layout = _layout(spark, place, (job.merge_every, job.buckets))
        job.work(spark, place, job.waiting(spark, place, schema, last), last + 1, layout)


def late_rows(spark: SparkSession, place: Place, schema: StructType) -> DataFrame:
    """Rows that came after the watermark had passed them; an error if there were none."""
    return spark.read.schema(schema).option("basePath", place.late()).parquet(f"{place.late()}/*")


def results(spark: SparkSession, place: Place) -> DataFrame:
    """All results written so far."""
    return spark.read.parquet(place.out()).drop("epoch")


# --- stateful steps ----------------------------------------------------------


def change_step(keys: Sequence[str], order: Sequence[str], code: str, policy: HotKeyPolicy = DEFAULT_POLICY):
    """Step that emits a row where a check's exit code differs from the one before; state (keys..., last_code)."""
    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        valid = rows.filter(F.col(code).isin(*EXIT_SEVERITY))
        seen = with_previous(valid, keys, order, {"previous": (code, None)}, policy)
        # The first row of a key in this batch follows the key's state.
        known = null_safe_join(seen, state, keys).withColumn(
            "previous", F.coalesce("previous", "last_code", F.lit(0))
        ).drop("last_code")
        changes = known.filter(F.col(code) != F.col("previous")).withColumn("severity", exit_severity(F.col(code)))
        touched = valid.groupBy(*keys).agg(F.max_by(code, F.struct(*order)).alias("last_code"))
        return changes, touched

    return step


def ratio_step(keys: Sequence[str], ts: str, hits: str, misses: str, policy: HotKeyPolicy = DEFAULT_POLICY):
    """Step that emits the hit ratio since the sample before; state (keys..., last_ts, last_hits, last_misses).

    Samples not newer than the state are left out; run the step with ``ts`` so that
    only samples after the watermark are, and these are kept in the side output.
    """
    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        merged = one_per_time(rows, keys, ts, [hits, misses], [hits, misses])
        state = state.withColumn("_known", F.lit(True))
        fresh = null_safe_join(merged, state, keys).filter(F.col("last_ts").isNull() | (F.col(ts) > F.col("last_ts")))
        fresh = fresh.withColumn("_there", F.lit(True))
        seen = with_previous(fresh, keys, [ts], {"_had": ("_there", None), "_hits": (hits, None), "_misses": (misses, None)}, policy)

        def before(previous: str, last: str) -> Column:
            # A sample before without a value gives no difference; only a key without one counts from 0.
            return F.when(F.col("_had"), F.col(previous)).when(F.col("_known"), F.col(last)).otherwise(F.lit(0).cast("bigint"))

        hit = F.col(hits) - before("_hits", "last_hits")
        miss = F.col(misses) - before("_misses", "last_misses")
        value = F.when((hit >= 0) & (miss >= 0) & (hit + miss > 0), hit / (hit + miss))
        ratios = seen.withColumn("ratio", value).filter(F.col("ratio").isNotNull()).select(*keys, ts, hits, misses, "ratio")
        touched = fresh.groupBy(*keys).agg(F.max_by(F.struct(ts, hits, misses), F.col(ts)).alias("_l")).select(
            *keys, F.col("_l")[ts].alias("last_ts"), F.col("_l")[hits].alias("last_hits"), F.col("_l")[misses].alias("last_misses")
        )
        return ratios, touched

    return step


def last_value_step(keys: Sequence[str], position: Sequence[str], value: str):
    """Step that keeps the last value per key; a key without news keeps its old value. State (keys..., position..., value)."""
    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        news = last_wins(rows, keys, position, [*position, value])
        both = last_wins(
            news.unionByName(null_safe_join(state, news.select(*keys), keys, "left_semi").select(*news.columns)),
            keys, position, [*position, value],
        )
        return both, both

    return step


def config_step(host: str, order: Sequence[str], content: Column, policy: HotKeyPolicy = DEFAULT_POLICY):
    """Step that flags a refreshed configuration as changed; state (host, last_hash). The first one is no change."""
    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        hashed = rows.withColumn("content_hash", F.sha2(content.cast("string").cast("binary"), 256)).withColumn("_there", F.lit(True))
        seen = with_previous(hashed, [host], order, {"_had": ("_there", None), "_before": ("content_hash", None)}, policy)
        # The row before counts even where it has no content; the state's only where there is none in this batch.
        known = null_safe_join(seen, state, [host]).withColumn("_before", F.when(F.col("_had"), F.col("_before")).otherwise(F.col("last_hash")))
        flagged = known.withColumn(
            "changed", F.col("_before").isNotNull() & ~F.col("content_hash").eqNullSafe(F.col("_before"))
        ).drop("_before", "last_hash", "_had", "_there")
        # A struct, as a null hash is news too.
        touched = hashed.groupBy(host).agg(F.max_by(F.struct("content_hash"), F.struct(*order)).alias("_l")).select(
            host, F.col("_l.content_hash").alias("last_hash")
        )
        return flagged, touched

    return step


def children_job(
    host: str, host_type: str, order: Sequence[str], content: Column, children: Column, ts: str | None = None, policy: HotKeyPolicy = DEFAULT_POLICY, **options
) -> Stateful:
    """Job that turns refreshed configurations into changes of the inventory below each host.

    Its results have the refreshes with ``changed`` and ``changes``, its state
    the children of every host, removed ones as tombstones; see ``refreshed_children``.
    """
    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, None]:
        return refreshed_children(rows, host, order, content, children, state, policy), None

    def touched(told: DataFrame) -> DataFrame:
        return children_state(told, host, order)

    return Stateful([host, "child"], f"{host} {host_type}, {CHILD_STATE}", step, ts, by=[host], from_results=touched, **options)


def run_counts(stream: DataFrame, place: Place, keys: Sequence[str], every: str | None = None) -> StreamingQuery:
    """Running counts per key, kept in Spark's own state; every batch writes the counts it changed."""
    counts = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def batch(rows: DataFrame, epoch: int) -> None:
        rows.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(place.out(epoch))

    return start(counts, place, batch, every, mode="update")


def latest_counts(spark: SparkSession, place: Place, keys: Sequence[str]) -> DataFrame:
    """Newest count of each key of ``run_counts``."""
    written = spark.read.parquet(place.out())
    return written.groupBy(*keys).agg(F.max_by("n", "epoch").alias("n"))


def with_refreshed_config(stream: DataFrame, place: Place, read_config: Callable[[], DataFrame], join: Callable[[DataFrame, DataFrame], DataFrame], every: str | None = None) -> StreamingQuery:
    """Join each micro-batch with the configuration as it is at that time."""
    def batch(rows: DataFrame, epoch: int) -> None:
        prepare(rows.sparkSession)
        join(rows, read_config()).write.mode("overwrite").parquet(place.out(epoch))

    return start(stream, place, batch, every)


def with_versions(
    stream: DataFrame, place: Place, read_versions: Callable[[], DataFrame], keys: Sequence[str], ts: str, values: Sequence[str],
    every: str | None = None, policy: HotKeyPolicy = DEFAULT_POLICY,
) -> StreamingQuery:
    """Join each row with the version of its key's settings that held at its time.

    The versions are read again for every micro-batch, so those that came since count.
    """
    return with_refreshed_config(stream, place, read_versions, lambda rows, versions: as_of_join(rows, versions, keys, ts, values, policy), every)
