"""Streaming queries: the tables are replayed as files, once over what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fleetspan.functions import text as T
from fleetspan.operators import config as CF
from fleetspan.operators import report as R
from fleetspan.operators import versions as VS
from fleetspan.plans.registry import REGISTRY, Streams, Tables, query
from fleetspan.plans import inputs as I
from fleetspan.plans import network as N
from fleetspan.session import local_table, scratch_path
from fleetspan.streaming import jobs as S


def _place(t: Tables, name: str) -> S.Place:
    return S.Place(scratch_path(t.spark, name))


#: Micro-batches of a replay, and seconds by which its rows come out of order.
BATCHES, DISORDER = 6, 5400


def _parts(t: Tables, df: DataFrame, name: str, ts: str, key: str) -> list[tuple[DataFrame, object]]:
    """``df`` cut by arrival, rows up to DISORDER seconds out of order, rows without a time first: the parts that have rows, and their newest time."""
    whole = f"{scratch_path(t.spark, f'{name}-source')}/all"
    arrival = F.unix_seconds(F.col(ts).cast("timestamp")) + F.pmod(F.xxhash64(key), F.lit(DISORDER))
    low, high = df.agg(F.min(arrival), F.max(arrival)).first()
    number = F.lit(0)
    if low is not None:
        number = F.when(arrival.isNull(), 0).otherwise(F.least(F.floor((arrival - low) / ((high - low + 1) / BATCHES)), F.lit(BATCHES - 1)))
    df.withColumn("_part", number.cast("int")).write.partitionBy("_part").parquet(whole)
    written = t.spark.read.schema(StructType([*df.schema.fields, StructField("_part", IntegerType())])).parquet(whole)
    there = written.groupBy("_part").agg(F.max(ts).alias("newest")).orderBy("_part").collect()
    return [(written.filter(F.col("_part") == r["_part"]).drop("_part"), r["newest"]) for r in there]


def _replay(t: Tables, df: DataFrame, name: str, ts: str, key: str, job: S.Stateful) -> tuple[DataFrame, DataFrame]:
    """Results and last state of a job over ``df`` that comes in BATCHES parts, each of as many files as Spark writes."""
    place = _place(t, name)
    source = scratch_path(t.spark, f"{name}-in")
    parts = _parts(t, df, name, ts, key)
    for i, (part, _) in enumerate(parts):
        part.write.parquet(f"{source}/part{i:03}")
        # The stream goes on where it was and takes what is new as one micro-batch.
        S.run_job(S.read_stream(t.spark, f"{source}/*", df.schema), place, job).awaitTermination()
    if not parts:
        none = t.spark.createDataFrame([], job.state_ddl)
        return job.step(df, none)[0], none
    S.drain(t.spark, place, df.schema, job)
    # A batch for each part, and one for the rows that waited.
    state = S.read_state(t.spark, place, len(parts) + 1, job.keys, job.state_ddl, job.merge_every)
    return S.results(t.spark, place), state


def _job(keys: list[str], state_ddl: str, step, ts: str) -> S.Stateful:
    return S.Stateful(keys, state_ddl, step, ts, DISORDER, merge_every=3, buckets=8)


def _twin(name: str) -> str:
    """SQL of the batch query with the same result."""
    return REGISTRY[name].sql


@query("T1 S6 K2", _twin("trap_events"))
def trap_stream(t: Tables) -> DataFrame:
    place = _place(t, "trap-stream")
    traps = I.traps(Streams(t.spark, t.sf_dir))
    mib = I.mib(t)
    S.run_stateless(traps, place, lambda rows: N.decode(rows, mib)).awaitTermination()
    return S.results(t.spark, place)


@query("T2 W6", _twin("source_counts"))
def count_stream(t: Tables) -> DataFrame:
    place = _place(t, "count-stream")
    S.run_counts(t.stream("events").select("user_id"), place, ["user_id"]).awaitTermination()
    return S.latest_counts(t.spark, place, ["user_id"])


@query("T3 S4 E36 A11", """
select user_id, 'queue.' || event_type || '.size' as metric, arg_max(value, event_id) as value from events where event_type in ('click', 'view') group by 1, 2
union all select user_id, 'queue.' || event_type || '.id', cast(max(event_id) as double) from events where event_type in ('click', 'view') group by 1, 2
""")
def log_tail_stream(t: Tables) -> DataFrame:
    place = _place(t, "log-stream")
    e = t.stream("events")
    line = F.concat(
        F.lit("group=queue, name="), "event_type", F.lit(", size="), F.col("value").cast("decimal(12,2)").cast("string"),
        F.lit(", id="), F.col("event_id").cast("string"),
    )
    wanted = [f"queue.{k}.{m}" for k in ("click", "view") for m in ("size", "id")]
    found = T.log_metrics(e.select("user_id", "event_id", line.alias("line")), "line", ["user_id", "event_id"], published=wanted)
    S.run_with_state(
        found, place, ["user_id", "metric"],
        "user_id BIGINT, metric STRING, event_id BIGINT, pair_no INT, value DOUBLE",
        S.last_value_step(["user_id", "metric"], ["event_id", "pair_no"], "value"),
    ).awaitTermination()
    return R.last_wins(S.results(t.spark, place), ["user_id", "metric"], ["event_id", "pair_no"], ["value"])


@query("T4 W5 K2", """
with c as (select user_id, ts, event_id, case event_type when 'error' then 2 when 'purchase' then 1 when 'signup' then 7 else 0 end as code from events),
r as (select *, lag(code, 1, 0) over (partition by user_id order by ts, event_id) as previous from c where code in (0, 1, 2))
select user_id, event_id, code, previous, case code when 0 then 'INFO' when 1 then 'WARN' else 'ERROR' end as severity from r where code <> previous
""")
def state_change_stream(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    code = F.when(kind == "error", 2).when(kind == "purchase", 1).when(kind == "signup", 7).otherwise(0)
    runs = t.events.select("user_id", "ts", "event_id", code.alias("code"))
    step = S.change_step(["user_id"], ["ts", "event_id"], "code")
    job = _job(["user_id"], "user_id BIGINT, last_code INT", step, "ts")
    return _replay(t, runs, "state-stream", "ts", "event_id", job)[0].select("user_id", "event_id", "code", "previous", "severity")


@query("T5 W2", _twin("counter_ratio"))
def counter_stream(t: Tables) -> DataFrame:
    counters = I.counters(t).select("user_id", "ts", "hits", "misses")
    step = S.ratio_step(["user_id"], "ts", "hits", "misses")
    job = _job(["user_id"], "user_id BIGINT, last_ts TIMESTAMP, last_hits BIGINT, last_misses BIGINT", step, "ts")
    found, _ = _replay(t, counters, "counter-stream", "ts", "user_id", job)
    return found.select("user_id", F.unix_micros("ts").alias("us"), F.round("ratio", 9).alias("ratio"))


@query("T6 W7", _twin("config_changes"))
def config_refresh_stream(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.concat("o_orderstatus", "o_orderpriority").alias("content"))
    step = S.config_step("o_custkey", ["o_orderdate", "o_orderkey"], F.col("content"))
    job = _job(["o_custkey"], "o_custkey BIGINT, last_hash STRING", step, "o_orderdate")
    return _replay(t, rows, "config-stream", "o_orderdate", "o_orderkey", job)[0].select("o_custkey", "o_orderkey", "changed")


@query("T7 W8", """
select user_id, event_type as metric, cast((epoch_us(ts) // 1000) // 600000 * 600000 as bigint) as bucket_ms, last(value order by ts, event_id) as value
from events group by all
""")
def schedule_stream(t: Tables) -> DataFrame:
    place = _place(t, "schedule-stream")
    interval = 600_000
    bucket = F.floor(F.unix_millis("ts") / interval) * interval
    rows = t.stream("events").select("user_id", F.col("event_type").alias("metric"), bucket.alias("bucket_ms"), "ts", "event_id", "value")
    keys = ["user_id", "metric", "bucket_ms"]
    S.run_with_state(
        rows, place, keys, "user_id BIGINT, metric STRING, bucket_ms BIGINT, ts TIMESTAMP, event_id BIGINT, value DOUBLE",
        S.last_value_step(keys, ["ts", "event_id"], "value"),
    ).awaitTermination()
    return R.last_wins(S.results(t.spark, place), keys, ["ts", "event_id"], ["value"])


@query("J13", """
select event_id, case event_type when 'error' then 'p1' when 'click' then 'p3' else 'none' end as priority from events
""")
def config_join_stream(t: Tables) -> DataFrame:
    place = _place(t, "config-join")

    def read_config() -> DataFrame:
        return local_table(t.spark, [("error", "p1"), ("click", "p3")], "event_type STRING, priority STRING")

    def join(rows: DataFrame, config: DataFrame) -> DataFrame:
        return rows.join(config, "event_type", "left").select("event_id", F.coalesce("priority", F.lit("none")).alias("priority"))

    S.with_refreshed_config(t.stream("events").select("event_id", "event_type"), place, read_config, join).awaitTermination()
    return S.results(t.spark, place)


# --- refreshed documents, rebuilt inventory ----------------------------------


def _refreshes(t: Tables) -> DataFrame:
    """Refreshed documents of hosts: some failed, some empty, some without a host or a time."""
    key, level = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
    service = lambda name, value: F.concat(F.lit('"'), name, F.lit('":{"level":["'), value, F.lit('"]}'))
    services = F.concat_ws(
        ",", service(F.lit("alpha"), F.col("o_orderstatus")), F.when(level < "3", service(F.lit("beta"), level)),
        service(F.concat(F.lit("svc"), (key % 3).cast("string")), F.lit("x")),
    )
    body = F.concat(
        F.lit('{"box":{"fleet":{"monitor":{"timeout":["'), (key % 7 > 0).cast("int").cast("string"), F.lit('"],"service":{'), services, F.lit("}}}}}")
    )
    return t.orders.select(
        F.when(F.col("o_custkey") % 50 > 0, F.col("o_custkey")).alias("host"), key.alias("refresh"),
        F.when(key % 97 > 0, F.col("o_orderdate")).alias("stamp"), F.when(key % 13 == 0, "{}").when(key % 11 > 0, body).alias("body"),
    )


_REFRESHES = """
with d as (
  select case when o_custkey % 50 > 0 then o_custkey end as host, o_orderkey as refresh, case when o_orderkey % 97 > 0 then o_orderdate end as stamp,
    case when o_orderkey % 13 = 0 then 'empty' when o_orderkey % 11 > 0 then 'full' end as kind, o_orderstatus as st, left(o_orderpriority, 1) as pr,
    case when o_orderkey % 7 > 0 then '1' else '0' end as tmo, 'svc' || (o_orderkey % 3) as svc
  from orders),
v as (select *, case kind when 'empty' then '' else concat_ws('/', tmo, st, case when pr < '3' then pr else '-' end, svc) end as content,
  row_number() over (partition by host order by stamp nulls first, refresh) as n from d where kind is not null),
f as (select *, lag(content) over (partition by host order by n) as before from v),
c as (
  select host, n, 'alpha' as child, tmo || st as settings from v where kind = 'full'
  union all select host, n, 'beta', tmo || pr from v where kind = 'full' and pr < '3'
  union all select host, n, svc, tmo || 'x' from v where kind = 'full'),
x as (
  select v.host, v.n, v.refresh, child, settings, false as old from c join v on c.host is not distinct from v.host and c.n = v.n
  union all select v.host, v.n, v.refresh, child, settings, true from c join v on c.host is not distinct from v.host and c.n + 1 = v.n),
e as (
  select host, n, refresh, child, case when bool_and(not old) then 'added' when bool_and(old) then 'removed' else 'changed' end as status
  from x group by host, n, refresh, child having count(*) = 1 or min(settings) <> max(settings))
"""
_CHANGES = _REFRESHES + """
select f.host, f.refresh, f.before is not null and f.before <> f.content as changed, e.child, e.status
from f left join e on f.host is not distinct from e.host and f.n = e.n
union all select host, refresh, false, null, null from d where kind is null
"""


def _told(found: DataFrame) -> DataFrame:
    rows = found.select("host", "refresh", "changed", F.explode_outer("changes").alias("c"))
    return rows.select("host", "refresh", "changed", "c.child", "c.status")


@query("T6 W7 W9 D7", _CHANGES)
def refreshed_services(t: Tables) -> DataFrame:
    rows = _refreshes(t)
    return _told(CF.refreshed_children(rows, "host", ["stamp", "refresh"], F.col("body"), CF.service_hashes(F.col("body"), "fleet")))


def _children_job() -> S.Stateful:
    body = F.col("body")
    return S.children_job(
        "host", "BIGINT", ["stamp", "refresh"], body, CF.service_hashes(body, "fleet"), "stamp", delay_seconds=DISORDER, merge_every=3, buckets=8
    )


@query("T6 W7 W9 D7 K3", f"""
select 'refresh' as part, * from ({_CHANGES})
union all select 'inventory', host, null, last(status order by n) = 'removed', child, null from ({_REFRESHES} select * from e) group by host, child
""")
def refreshed_services_stream(t: Tables) -> DataFrame:
    """What the stream told of every refresh, and the inventory that it has built: ``changed`` is true for a service that is gone."""
    found, state = _replay(t, _refreshes(t), "children-stream", "stamp", "refresh", _children_job())
    built = state.filter(F.col("child").isNotNull()).select(
        F.lit("inventory").alias("part"), "host", F.lit(None).cast("bigint").alias("refresh"), F.col("removed").alias("changed"), "child",
        F.lit(None).cast("string").alias("status"),
    )
    return _told(found).withColumn("part", F.lit("refresh")).unionByName(built)


# --- settings that change ------------------------------------------------------


def _plans(t: Tables) -> DataFrame:
    """Readings of users' settings: some repeat the one before, some are at the same time, some have no value."""
    plan = F.when(F.col("event_id") % 9 > 0, F.concat(F.lit("plan"), (F.col("event_id") % 2).cast("string")))
    return t.events.filter(F.col("event_type") == "signup").select(_user(), "ts", "event_id", plan.alias("plan"))


def _user():
    return F.when(F.col("user_id") % 10 > 0, F.col("user_id")).alias("user")


def _asking(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") != "signup").select(_user(), "ts", "event_id")


_VERSIONS = """
with r as (select case when user_id % 10 > 0 then user_id end as user, ts, event_id, case when event_id % 9 > 0 then 'plan' || (event_id % 2) end as plan, event_type = 'signup' as reading from events),
o as (select user, ts, max_by(struct_pack(plan := plan), event_id).plan as plan from r where reading group by user, ts),
l as (select *, lag(struct_pack(plan := plan)) over (partition by user order by ts) as before from o),
v as (select user, plan, ts as valid_from from l where before is null or before.plan is distinct from plan)
"""
_AS_OF = _VERSIONS + """
select r.event_id, v.plan, cast(epoch_us(v.valid_from) as bigint) as since_us
from (select *, coalesce(user, -1) as k from r where not reading) r asof left join (select *, coalesce(user, -1) as k from v) v on r.k = v.k and r.ts >= v.valid_from
"""


def _versions(readings: DataFrame) -> DataFrame:
    return VS.versions_of(readings, ["user"], "ts", ["event_id"], ["plan"])


def _since(found: DataFrame) -> DataFrame:
    return found.select("event_id", "plan", F.unix_micros("since").alias("since_us"))


@query("J13 W7", _VERSIONS + """
select user, plan, cast(epoch_us(valid_from) as bigint) as from_us, cast(epoch_us(lead(valid_from) over (partition by user order by valid_from)) as bigint) as to_us from v
""")
def setting_versions(t: Tables) -> DataFrame:
    found = VS.valid_to(_versions(_plans(t)), ["user"])
    return found.select("user", "plan", F.unix_micros("valid_from").alias("from_us"), F.unix_micros("valid_to").alias("to_us"))


@query("J13", _AS_OF)
def settings_as_of(t: Tables) -> DataFrame:
    versions = _versions(_plans(t)).withColumn("since", F.col("valid_from"))
    return _since(VS.as_of_join(_asking(t), versions, ["user"], "ts", ["plan", "since"]))


@query("J13", _AS_OF)
def changing_config_stream(t: Tables) -> DataFrame:
    """Rows in parts, joined with settings of which more versions are known from part to part."""
    rows, place = _asking(t), _place(t, "versions-stream")
    source, config = (scratch_path(t.spark, f"versions-{x}") for x in ("in", "config"))
    parts = _parts(t, rows, "versions", "ts", "event_id")
    read: list[str] = []

    def known() -> DataFrame:
        return t.spark.read.parquet(read[-1])

    for i, (part, newest) in enumerate(parts):
        # What has been read by the time of the part: a configuration of its own.
        readings = _plans(t).filter(F.col("ts") <= F.lit(newest))
        _versions(readings).withColumn("since", F.col("valid_from")).write.parquet(f"{config}/{i}")
        read.append(f"{config}/{i}")
        part.write.parquet(f"{source}/part{i:03}")
        stream = S.read_stream(t.spark, f"{source}/*", rows.schema)
        S.with_versions(stream, place, known, ["user"], "ts", ["plan", "since"]).awaitTermination()
    if not parts:
        return _since(VS.as_of_join(rows, _versions(_plans(t)).withColumn("since", F.col("valid_from")), ["user"], "ts", ["plan", "since"]))
    return _since(S.results(t.spark, place))
