"""Queries that read captured inputs back from the shared folder, as the readers find them there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.plans.registry import Tables, query
from fleetspan.session import materialize, scratch_path
from fleetspan.sources import readers as RD


def _through(t: Tables, df: DataFrame, name: str, reader: Callable, fmt: str = "parquet") -> DataFrame:
    """``df`` written in a format and read by a reader."""
    path = scratch_path(t.spark, name)
    df.write.format(fmt).save(path)
    return reader(t.spark, path, fmt)


@query("S1", """
select 'https://host/' || user_id as resource_key, cast(200 + event_id % 5 as int) as code, event_type as server, props as body, event_id * 3 as elapsed_ms
from events
""")
def captured_responses(t: Tables) -> DataFrame:
    df = t.events.select(
        F.concat(F.lit("https://host/"), F.col("user_id").cast("string")).alias("resource_key"), "ts", (200 + F.col("event_id") % 5).cast("int").alias("code"),
        F.create_map(F.lit("Server"), F.array("event_type")).alias("headers"), F.col("props").alias("body"), (F.col("event_id") * 3).alias("elapsed_ms"),
    )
    return _through(t, df, "responses", RD.read_responses, "json").select(
        "resource_key", "code", F.col("headers")["Server"][0].alias("server"), "body", "elapsed_ms"
    )


@query("S6", """
select event_id as trap_id, cast(epoch_us(ts) as bigint) as us, cast(1 + event_id % 2 as int) as version, event_type as value from events
""")
def captured_traps(t: Tables) -> DataFrame:
    bind = F.struct(F.lit("1.3.6.1.2.1.1.5.0").alias("oid"), F.lit("OctetString").alias("type"), F.col("event_type").alias("value"))
    df = t.events.select(F.col("event_id").alias("trap_id"), "ts", (1 + F.col("event_id") % 2).cast("int").alias("version"), F.array(bind).alias("varbinds"))
    return _through(t, df, "traps", RD.read_traps, "orc").select(
        "trap_id", F.unix_micros("ts").alias("us"), "version", F.col("varbinds")[0]["value"].alias("value")
    )


@query("S7", """
select 'agent-' || user_id as agent, '1.3.6.1.' || event_id as oid, cast(value as varchar) as value, event_type = 'error' as is_exception from events
""")
def captured_varbinds(t: Tables) -> DataFrame:
    df = t.events.select(
        F.concat(F.lit("agent-"), F.col("user_id").cast("string")).alias("agent"), "ts", F.concat(F.lit("1.3.6.1."), F.col("event_id").cast("string")).alias("oid"),
        F.col("value").cast("string").alias("value"), (F.col("event_type") == "error").alias("is_exception"),
    )
    return _through(t, df, "varbinds", RD.read_varbinds).select("agent", "oid", "value", "is_exception")


@query("S13", """
select 'host-' || (user_id % 9) as host, 'check' as command, cast(event_id % 4 as int) as exit_code, event_type || chr(10) || props as stdout, event_id * 1000 as elapsed_ns
from events
""")
def captured_command_runs(t: Tables) -> DataFrame:
    df = t.events.select(
        F.concat(F.lit("host-"), (F.col("user_id") % 9).cast("string")).alias("host"), F.lit("check").alias("command"), (F.col("event_id") % 4).cast("int").alias("exit_code"),
        F.concat("event_type", F.lit("\n"), "props").alias("stdout"), (F.col("event_id") * 1000).alias("elapsed_ns"), "ts",
    )
    return _through(t, df, "command-runs", RD.read_command_runs, "json").select("host", "command", "exit_code", "stdout", "elapsed_ns")


@query("S14", """
select 'host-' || s_nationkey as host, s_suppkey as pid, 'java' as basename, '-Dname=' || s_name as argument, '/home/' || s_nationkey as home from supplier
""")
def captured_processes(t: Tables) -> DataFrame:
    df = t.supplier.select(
        F.concat(F.lit("host-"), F.col("s_nationkey").cast("string")).alias("host"), F.col("s_suppkey").cast("bigint").alias("pid"), F.lit("java").alias("basename"),
        F.array(F.lit("java"), F.concat(F.lit("-Dname="), "s_name")).alias("argv"), F.create_map(F.lit("HOME"), F.concat(F.lit("/home/"), F.col("s_nationkey").cast("string"))).alias("env"),
    )
    return _through(t, df, "processes", RD.read_processes).select("host", "pid", "basename", F.col("argv")[1].alias("argument"), F.col("env")["HOME"].alias("home"))


@query("S17", """
select 'host-' || (user_id % 9) as host, 'app:type=' || event_type as bean, 'Value' as attribute, cast(value as varchar) as value, cast(epoch_us(ts) as bigint) as us
from events
""")
def captured_attributes(t: Tables) -> DataFrame:
    df = t.events.select(
        F.concat(F.lit("host-"), (F.col("user_id") % 9).cast("string")).alias("host"), F.concat(F.lit("app:type="), "event_type").alias("bean"),
        F.lit("Value").alias("attribute"), F.col("value").cast("string").alias("value"), "ts",
    )
    return _through(t, df, "attributes", RD.read_attributes).select("host", "bean", "attribute", "value", F.unix_micros("ts").alias("us"))


def _files(t: Tables) -> str:
    """A text file or more for each kind of event, a line for each event."""
    path = scratch_path(t.spark, "text")
    line = F.concat(F.col("event_id").cast("string"), F.lit(" user="), F.col("user_id").cast("string"), F.lit(" "), "props")
    # A frequent kind is written by several tasks, as several files.
    dealt = t.events.select("event_type", line.alias("value"), F.pmod("event_id", F.lit(8)).alias("cut")).repartition("event_type", "cut")
    dealt.drop("cut").write.partitionBy("event_type").text(path)
    return path


def _kind(column: str):
    return F.regexp_extract(column, r"event_type=([a-z]+)", 1).alias("event_type")


@query("S2 S3", """
select event_type, event_id || ' user=' || user_id || ' ' || props as line from events
""")
def captured_bodies(t: Tables) -> DataFrame:
    return RD.read_lines(t.spark, f"{_files(t)}/*").select(_kind("resource_key"), "line")


@query("S4", """
select event_type, event_id || ' user=' || user_id || ' ' || props as line, event_id % 3 = 0 as early from events where event_id % 3 < 2
""")
def captured_log_tail(t: Tables) -> DataFrame:
    # The event number stands for the place in the file: a third was read before.
    log = RD.read_log(t.spark, f"{_files(t)}/*")
    number = F.regexp_extract("line", r"^(\d+)", 1).cast("bigint")
    rows = log.select("file", F.lit(3).cast("bigint").alias("length"), (2 - number % 3).alias("pos"), "line")
    offsets = rows.select("file", F.lit(1).cast("bigint").alias("offset")).distinct()
    return RD.tail_lines(rows, offsets).select(_kind("file"), "line", (F.col("pos") == 2).alias("early"))


@query("S12", """
select event_type, cast(sum(octet_length(encode(event_id || ' user=' || user_id || ' ' || props)) + 1) as bigint) as bytes from events group by 1
""")
def captured_listing(t: Tables) -> DataFrame:
    return RD.list_files(t.spark, _files(t)).filter(F.endswith("path", F.lit(".txt"))).groupBy(_kind("path")).agg(F.sum("length").alias("bytes"))


@query("S16", """
select 'plugin' as resource_type, 'metric-' || p_partkey as metric, case when p_size % 2 = 0 then 'trait' else 'measurement' end as data_type,
  cast(case when p_size % 3 = 0 then p_size * 1000 else 600000 end as bigint) as interval_ms
from part
""")
def captured_definitions(t: Tables) -> DataFrame:
    size = F.col("p_size")
    tag = F.concat(
        F.lit('<metric property="metric-'), F.col("p_partkey").cast("string"), F.lit('"'),
        F.when(size % 2 == 0, ' dataType="trait"').otherwise(""),
        F.when(size % 3 == 0, F.concat(F.lit(' defaultInterval="'), (size * 1000).cast("string"), F.lit('"'))).otherwise(""),
        F.lit("/>"),
    )
    # A descriptor is a file of its own, of at most a thousand metrics.
    file = F.floor(F.col("p_partkey") / 1000).alias("file")
    bodies = t.part.groupBy(file).agg(F.array_join(F.collect_list(tag), "\n").alias("tags"))
    path = scratch_path(t.spark, "definitions")
    bodies.select("file", F.concat(F.lit("<plugin>\n"), "tags", F.lit("\n</plugin>")).alias("value")).write.partitionBy("file").text(path)
    return RD.read_definitions(t.spark, f"{path}/*", "plugin").select("resource_type", "metric", "data_type", "interval_ms")


# --- logs that grow, shrink and are rotated between two runs --------------------

#: Files of a kind of event, so that a frequent kind is written by several tasks.
CUTS = 8


def _logs(t: Tables, rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (name, line, position) as one text file per name and cut, and the lines with their offsets."""
    path = scratch_path(t.spark, label)
    cut = F.pmod(F.col("event_id"), F.lit(CUTS)).alias("cut")
    dealt = rows.select("name", cut, "position", "line").repartition("name", "cut").sortWithinPartitions("name", "cut", "position")
    dealt.select("name", "cut", F.col("line").alias("value")).write.partitionBy("name", "cut").option("lineSep", "\n").text(path)
    file = F.concat_ws("/", F.regexp_extract("path", "name=([^/]+)/", 1), F.regexp_extract("path", "cut=([0-9]+)/", 1))
    # Read for the ledger and for the lines: so placed once.
    return materialize(RD.read_lines_at(t.spark, f"{path}/*/*", file), f"{label}-lines")


def _log_rows(t: Tables) -> tuple[DataFrame, DataFrame]:
    """What is in the files at the first and at the second run."""
    e, part = t.events, F.col("event_id") % 4
    line = F.concat(F.col("event_id").cast("string"), F.lit(" user="), F.col("user_id").cast("string"), F.lit(" "), "props")
    name, rows = F.col("event_type"), e.select("event_id", "event_type", line.alias("line"), part.alias("part"))

    def at(condition, number, new_name=name) -> DataFrame:
        return rows.filter(condition).select(new_name.alias("name"), "event_id", (number * 1_000_000_000 + F.col("event_id")).alias("position"), "line")

    late = (part >= 2).cast("bigint")
    first = at((part < 2) & (name != "signup"), F.lit(0))
    second = at(name == "click", late)  # grown
    second = second.unionByName(at((name == "view") & (F.col("event_id") % 20 < 10) & (part < 2), F.lit(0)))  # cut short
    second = second.unionByName(at((name == "purchase") & (part >= 2), F.lit(0)))  # begun anew
    second = second.unionByName(at((name == "purchase") & (part < 3), (part == 2).cast("bigint"), F.lit("purchase.1")))  # the old one, renamed
    second = second.unionByName(at((name == "error") & (part < 2), F.lit(0)))  # as it was
    return first, second.unionByName(at(name == "signup", F.lit(0)))  # new


@query("S4", """
with e as (select event_id, event_type, event_id % 4 as part, event_id % 8 as cut, event_id || ' user=' || user_id || ' ' || props as line from events),
files as (
  select 1 as run, event_type as name, cut, event_id as position, line from e where part < 2 and event_type <> 'signup'
  union all select 2, event_type, cut, case when part >= 2 then 1000000000 else 0 end + event_id, line from e where event_type = 'click'
  union all select 2, event_type, cut, event_id, line from e where event_type = 'view' and event_id % 20 < 10 and part < 2
  union all select 2, event_type, cut, event_id, line from e where event_type = 'purchase' and part >= 2
  union all select 2, 'purchase.1', cut, case when part = 2 then 1000000000 else 0 end + event_id, line from e where event_type = 'purchase' and part < 3
  union all select 2, event_type, cut, event_id, line from e where event_type = 'error' and part < 2
  union all select 2, event_type, cut, event_id, line from e where event_type = 'signup'),
l as (select *, cast(sum(octet_length(encode(line)) + 1) over (partition by run, name, cut order by position) as bigint) as stop from files),
f as (select run, name, cut, max(stop) as size, left(arg_min(line, position), 256) as head from l group by run, name, cut),
k as (select f.*, o.size as known, coalesce(starts_with(f.head, o.head), false) as same from f left join f o on f.run = 2 and o.run = 1 and f.name = o.name and f.cut = o.cut),
m as (select head, max(size) as moved from f where run = 1 and not exists (select 1 from k where k.run = 2 and k.name = f.name and k.cut = f.cut and k.same) group by head having count(*) = 1),
b as (select k.*, case when run = 1 then 0 when same then known when known is null then moved end as guess from k left join m on k.head = m.head),
g as (select *, case when guess <= size then guess else 0 end as begin from b)
select l.run, l.name || '/' || l.cut as file, l.line, cast(l.stop - octet_length(encode(l.line)) - 1 as bigint) as start
from l join g on l.run = g.run and l.name = g.name and l.cut = g.cut where l.stop > g.begin
""")
def tailed_files(t: Tables) -> DataFrame:
    first, second = _log_rows(t)
    empty = t.spark.createDataFrame([], RD.LEDGER)
    new, ledger = RD.tail_files(_logs(t, first, "log-first"), empty)
    newer, _ = RD.tail_files(_logs(t, second, "log-second"), materialize(ledger, "ledger"))
    return new.withColumn("run", F.lit(1)).unionByName(newer.withColumn("run", F.lit(2)))
