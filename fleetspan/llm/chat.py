"""Chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation many times, each time with one more turn. The
turns of every conversation get a rolling hash of the turns so far. A
conversation whose last hash is the hash of an earlier turn of a longer one is
a snapshot of it; anti-joins keep the maximal conversations, which are then
rendered. Of equal conversations the one with the smallest id stays. Only
DataFrame functions are used.

The rolling hash is a sum of 128-bit hashes of (place, role, text), so it is
found by running sums: inside runs of bounded length of a conversation first,
then over the runs. Runs are cut by turn numbers; one that has more rows than
that (turns without a number, or with the same one) or more text than a row
should hold is sorted into segments and cut by rows and by length. No task needs
a whole conversation, and a long one is rendered in parts. The different rows
are found and written once, for all that read them.

Defined results: turns are ordered by turn (a null before 0), role and text;
repeated rows count once. A null role is rendered as ``unknown``, a null text as
empty, but they differ from these in the comparison. Rows without conv_id form
one conversation without id. Marks of the format inside texts and roles are
broken by a space, so that text can't forge turns. Further columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetspan.llm.common import query, table
from fleetspan.session import materialize

#: Turn numbers and most rows of a run: what is rendered in one row.
RUN = 1024
#: Characters of a run, but for its last text.
LENGTH = 1 << 25
#: Rows, and characters, that one task sorts, of a run with more rows or text than that.
SEGMENT, SEGMENT_LENGTH = 100_000, 1 << 28
# The marks of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Parts that the two 64-bit hashes are summed in: 32 bits each, so 2^31 turns can't overflow.
PARTS = ("_s0", "_s1", "_s2", "_s3")


def ordered() -> list[Column]:
    """The order of turns; it is a full one, as equal rows count once."""
    return [F.coalesce("turn", F.lit(0)), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, run, turn, role, text of each different row; a run has RUN rows at most, and LENGTH characters beside its last text."""
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )
    by_turn = F.floor(F.coalesce("turn", F.lit(0)) / RUN).cast("long")
    rows = materialize(rows.distinct().withColumn("by_turn", by_turn), "chat-rows")
    size = F.coalesce(F.length("role"), F.lit(0)).cast("long") + F.coalesce(F.length("text"), F.lit(0))
    # Runs with more rows than turn numbers, or much text, each with its number of rows and characters.
    large = rows.groupBy("conv_id", "by_turn").agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    large = large.where((F.col("n") > RUN) | (F.col("size") > LENGTH))
    large = materialize(large.select(F.col("conv_id").alias("_conv"), F.col("by_turn").alias("_run"), "n", "size"), "chat-large")
    whole = lambda df, segment, at: df.withColumn("run", F.struct("by_turn", segment.alias("segment"), at.alias("at"))).select("conv_id", "run", "turn", "role", "text")
    n, length = large.agg(F.sum("n"), F.sum("size")).first()
    if not n:
        return whole(rows, F.lit(0), F.lit(0).cast("long"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("by_turn") == F.col("_run"))
    small = whole(rows.join(large, same, "left_anti"), F.lit(0), F.lit(0).cast("long"))
    cut = rows.join(large, same, "left_semi").repartitionByRange(ceil(n / SEGMENT + length / SEGMENT_LENGTH) + 1, F.col("conv_id"), F.col("by_turn"), *ordered())
    # Written once, so that the cuts are the same for every later reader and retry.
    cut = materialize(cut.withColumn("_segment", F.spark_partition_id()), "chat-segments")
    inside = Window.partitionBy("conv_id", "by_turn", "_segment").orderBy(*ordered())
    before = F.coalesce(F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Both grow with the order, so their sum changes wherever one of them does.
    cut = cut.withColumn("_at", (F.floor((F.row_number().over(inside) - 1) / RUN) + F.floor(before / LENGTH)).cast("long"))
    return small.unionByName(whole(cut, F.col("_segment"), F.col("_at")))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, run, place (from 1), h1 and h2 (the rolling hash) and last, of every turn; texts are left away."""
    # Nulls differ from any text: the hash of a null is its seed, so a flag goes with it.
    parts = [F.col("role"), F.col("role").isNull(), F.col("text"), F.col("text").isNull()]
    rows = turns.select("conv_id", "run", "turn", F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"), "role", "text")
    inside = Window.partitionBy("conv_id", "run").orderBy(*ordered())
    rows = rows.select("conv_id", "run", "a", "b", F.row_number().over(inside).alias("at"))
    rows = materialize(rows, "chat-turns")

    # Turns before each run; a conversation has few runs.
    over_runs = Window.partitionBy("conv_id").orderBy("run")
    before = over_runs.rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("conv_id").alias("_conv"), F.col("run").alias("_run"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"), F.sum("n").over(Window.partitionBy("conv_id")).alias("size"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("run") == F.col("_run"))
    placed = rows.join(sizes, same).select("conv_id", "run", "at", (F.col("at") + F.col("skip")).alias("place"), "size", "a", "b")
    h1, h2 = F.xxhash64("place", "a"), F.xxhash64("b", "place", F.lit(7))
    low = F.lit(0xFFFFFFFF)
    cut = dict(zip(PARTS, (h1.bitwiseAND(low), F.shiftrightunsigned(h1, 32), h2.bitwiseAND(low), F.shiftrightunsigned(h2, 32)), strict=True))
    placed = placed.select("conv_id", "run", "at", "place", "size", *(c.alias(p) for p, c in cut.items()))

    running = Window.partitionBy("conv_id", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.select("conv_id", "run", "place", "size", *(F.sum(p).over(running).alias(p) for p in PARTS))
    totals = placed.groupBy("conv_id", "run").agg(*(F.sum(p).alias(p) for p in PARTS))
    totals = totals.select(F.col("conv_id").alias("_conv"), F.col("run").alias("_run"), *(F.coalesce(F.sum(p).over(before), F.lit(0)).alias(f"{p}_skip") for p in PARTS))
    whole = summed.join(totals, same).select("conv_id", "run", "place", "size", *((F.col(p) + F.col(f"{p}_skip")).alias(p) for p in PARTS))
    return whole.select(
        "conv_id",
        "run",
        "place",
        F.xxhash64("_s0", "_s1", "_s2", "_s3").alias("h1"),
        F.xxhash64("_s3", "_s1", F.lit(3), "_s2", "_s0").alias("h2"),
        (F.col("place") == F.col("size")).alias("last"),
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_equal (further conversations equal to it) of the maximal conversations."""
    whole = hashed.where("last").groupBy("place", "h1", "h2")
    # min skips nulls: the conversation without id stays only if it has no equal.
    whole = whole.agg(F.min("conv_id").alias("conv_id"), (F.count("*") - 1).alias("n_equal"))
    begun = hashed.where(~F.col("last")).select("place", "h1", "h2").distinct()
    kept = whole.join(begun, ["place", "h1", "h2"], "left_anti")
    return kept.select("conv_id", F.col("place").cast("int").alias("n_turns"), "n_equal")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """conv_id, part (from 0), n_turns and rendered text of the kept conversations."""
    broken = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    line = F.concat(
        F.lit(OPEN),
        broken(F.coalesce("role", F.lit("unknown"))),
        F.lit("\n"),
        broken(F.coalesce("text", F.lit(""))),
        F.lit(CLOSE + "\n"),
    )
    found = turns.join(kept.select(F.col("conv_id").alias("_conv")), F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    row = F.struct(F.coalesce("turn", F.lit(0)).alias("at"), F.col("turn"), F.col("role"), F.col("text"), line.alias("line"))
    parts = found.groupBy("conv_id", "run").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    parts = parts.select("conv_id", "run", F.size("rows").alias("n_turns"), F.array_join(F.col("rows")["line"], "").alias("rendered"))
    # Parts are numbered without their texts, which stay where they are.
    part = F.row_number().over(Window.partitionBy("conv_id").orderBy("run")) - 1
    numbers = found.select("conv_id", "run").distinct().select(F.col("conv_id").alias("_conv"), F.col("run").alias("_run"), part.alias("part"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("run") == F.col("_run"))
    return parts.join(numbers, same).select("conv_id", "part", "n_turns", "rendered")


def collapse(conversations: DataFrame) -> DataFrame:
    """Rendered maximal conversations."""
    turns = turns_of(conversations)
    return render(turns, materialize(maximal(prefixes(turns)), "chat-kept"))


# Each conversation's texts so far, as one string; snapshots are those that equal an earlier one of a longer conversation.
SQL = f"""
with turns as (
  select distinct conv_id, turn, role, text,
    '{OPEN}' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |')
      || '{CLOSE}' || chr(10) as line
  from conversations
), so_far as (
  select conv_id, md5(string_agg(md5(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n')), '') over w) as h,
    row_number() over w as place, count(*) over (partition by conv_id) as size
  from turns window w as (partition by conv_id order by coalesce(turn, 0), turn nulls first, role nulls first, text nulls first
    rows between unbounded preceding and current row)
), kept as (
  select min(conv_id) as conv_id from so_far where place = size
    and (place, h) not in (select place, h from so_far where place < size) group by place, h
)
select t.conv_id, 0 as part, count(*)::int as n_turns,
  string_agg(line, '' order by coalesce(turn, 0), turn nulls first, role nulls first, text nulls first) as rendered
from turns t join kept k on t.conv_id is not distinct from k.conv_id group by t.conv_id
"""


@query(SQL)
def op2_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "conversations"))
