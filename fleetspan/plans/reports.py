"""Queries that turn values into reports and check them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.functions import coerce as C
from fleetspan.operators.counters import schedule_sample
from fleetspan.operators.digest import digest_entries
from fleetspan.operators.events import state_changes
from fleetspan.operators.inventory import upsert_inventory
from fleetspan.operators.jobs import status_totals as totals
from fleetspan.operators.snmp import publishable
from fleetspan.operators import metadata as M
from fleetspan.operators import report as R
from fleetspan.plans.registry import Tables, query
from fleetspan.plans import inputs as I
from fleetspan.session import local_table, scratch_path
from fleetspan.sources.readers import metastore_tables as tables_with_partitions
from fleetspan.sources.readers import table_locations as locations
from fleetspan.sources.sinks import read_runs, write_events, write_report

DAY_MS = 86_400_000

# Requested metrics of the flagship: (metric, data_type, interval_ms).
REQUESTED = [
    ("click", "measurement", DAY_MS),
    ("view", "measurement", DAY_MS),
    ("purchase", "measurement", DAY_MS),
    ("error", "measurement", DAY_MS // 4),
    ("k", "measurement", DAY_MS),
    ("absent", "measurement", DAY_MS),
]


def samples(t: Tables) -> DataFrame:
    """Every event's own value and the leaves of its document, from one scan."""
    own = F.array(F.struct(F.col("event_type").alias("key"), F.col("value").cast("string").alias("text")))
    leaves = F.transform(
        F.coalesce(digest_entries(F.col("props")), F.array().cast("array<struct<key: string, kind: string, text: string>>")),
        lambda e: F.struct(e["key"].alias("key"), e["text"].alias("text")),
    )
    return (
        t.events.select("event_id", "user_id", "ts", F.explode(F.concat(own, leaves)).alias("_s"))
        .select("event_id", "user_id", "ts", F.col("_s.key").alias("metric"), C.to_numeric(F.col("_s.text")).alias("value"))
        .filter(F.col("value").isNotNull())
    )


@query("E3 E8 E9 J1 W8 A11 S9", """
with d(metric, interval_ms) as (values ('click', 86400000), ('view', 86400000), ('purchase', 86400000), ('error', 21600000), ('k', 86400000)),
s as (
  select event_id, user_id, ts, event_type as metric, value from events
  union all select event_id, user_id, ts, 'k', try_cast(props->>'$.k' as double) from events)
select user_id, s.metric, cast((epoch_us(ts) // 1000) // interval_ms * interval_ms as bigint) as bucket_ms, last(value order by ts, event_id) as value
from s join d on s.metric = d.metric where value is not null group by all
""")
def metric_report(t: Tables) -> DataFrame:
    definitions = local_table(t.spark, REQUESTED, "metric STRING, data_type STRING, interval_ms BIGINT")
    return schedule_sample(
        samples(t), definitions.select("metric", "interval_ms"), ["user_id"], tie=["event_id"]
    )


@query("J1 U2", """
with digest as (select user_id, event_type as metric, max(value) as value from events where event_type <> 'view' group by all),
native as (select user_id, event_type as metric, min(value) as value from events group by all)
select user_id, metric, coalesce(d.value, n.value) as value
from native n left join digest d using (user_id, metric) where metric in ('click', 'view', 'error')
""")
def report_with_fallback(t: Tables) -> DataFrame:
    wanted = local_table(t.spark, [("click",), ("view",), ("error",), ("absent",)], "metric STRING")
    e = t.events.select("user_id", F.col("event_type").alias("metric"), "value")
    digest = e.filter("metric <> 'view'").groupBy("user_id", "metric").agg(F.max("value").alias("value"))
    native = e.groupBy("user_id", "metric").agg(F.min("value").alias("value"))
    return R.report(wanted, digest, native, resource=["user_id"])


@query("U2 J1", """
select distinct user_id, event_type as metric from events e
where not exists (select 1 from events f where f.user_id = e.user_id and f.event_type = e.event_type and f.value > 100)
""")
def unserved_requests(t: Tables) -> DataFrame:
    e = t.events.select("user_id", F.col("event_type").alias("metric"), "value")
    return R.unserved(e.select("user_id", "metric").distinct(), e.filter("value > 100"), ["user_id", "metric"])


def _contract(t: Tables) -> tuple[DataFrame, DataFrame]:
    kind = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    reported = t.events.select(
        kind.alias("resource_type"), F.col("user_id").alias("resource_key"), F.col("event_type").alias("metric")
    )
    definitions = local_table(
        t.spark,
        [("even", "click"), ("even", "error"), ("even", "uptime"), ("odd", "view"), ("odd", "signup"), ("odd", "purchase")],
        "resource_type STRING, metric STRING",
    )
    # Customers are resources too; most of them report nothing.
    key = F.col("c_custkey")
    inventory = t.customer.select(F.when(key % 2 == 0, "even").otherwise("odd").alias("resource_type"), key.cast("bigint").alias("resource_key"))
    return R.contract(definitions, reported, inventory=inventory)


_CONTRACT_SQL = """
with d(resource_type, metric) as (values ('even', 'click'), ('even', 'error'), ('even', 'uptime'), ('odd', 'view'), ('odd', 'signup'), ('odd', 'purchase')),
r as (select distinct case when user_id % 2 = 0 then 'even' else 'odd' end as resource_type, user_id as resource_key, event_type as metric from events),
a as (select distinct resource_type, resource_key from r union select case when c_custkey % 2 = 0 then 'even' else 'odd' end, c_custkey from customer)
"""


@query("J6 F9", _CONTRACT_SQL + """
select a.resource_type, resource_key, d.metric from a join d on a.resource_type = d.resource_type
where not exists (select 1 from r x where x.resource_key = a.resource_key and x.metric = d.metric)
""")
def contract_missing(t: Tables) -> DataFrame:
    return _contract(t)[0]


@query("J6", _CONTRACT_SQL + """
select r.resource_type, resource_key, r.metric from r
where not exists (select 1 from d where d.resource_type = r.resource_type and d.metric = r.metric)
""")
def contract_unexpected(t: Tables) -> DataFrame:
    return _contract(t)[1]


@query("J6", """
select s_suppkey, 'port' as setting from supplier where s_suppkey % 4 in (0, 1)
union all select s_suppkey, 'home' from supplier
""")
def settings_missing(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    settings = F.create_map(
        F.lit("url"), F.lit("http://x"), F.lit("port"), F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, "").otherwise(n.cast("string"))
    )
    return R.missing_settings(t.supplier.select("s_suppkey", settings.alias("settings")), "settings", ["url", "port", "home"], ["s_suppkey"])


@query("F9", """
select event_id, 'k' as key, props->>'$.k' as value from events where event_id % 3 = 2
""")
def present_values(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.lit(None)).when(F.col("event_id") % 3 == 1, "").otherwise(F.get_json_object("props", "$.k"))
    rows = t.events.select("event_id", F.lit("k").alias("key"), raw.alias("value"))
    return rows.filter(R.present(F.col("value")))


@query("F12 J7", "select event_id, event_type from events where event_type in ('click', 'error')")
def metric_whitelist(t: Tables) -> DataFrame:
    listed = local_table(t.spark, [("click",), ("error",), ("none",)], "event_type STRING")
    return t.events.select("event_id", "event_type").join(listed, "event_type", "left_semi")


@query("A11", "select user_id, event_type, arg_max(value, event_id) as value, cast(max(event_id) as bigint) as event_id from events group by all")
def last_value_wins(t: Tables) -> DataFrame:
    return R.last_wins(t.events, ["user_id", "event_type"], ["event_id"], ["value", "event_id"])


@query("A12", """
select user_id, '{' || string_agg('"' || event_type || '":' || n, ',' order by event_type) || '}' as report from
  (select user_id, event_type, count(*) as n from events where event_type in ('click', 'error', 'view') group by all)
group by user_id
""")
def report_as_map(t: Tables) -> DataFrame:
    counts = t.events.groupBy("user_id", F.col("event_type").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    wide = R.report_map(counts, ["user_id"], ["click", "error", "view"])
    return wide.select("user_id", F.to_json("report").alias("report"))


@query("A13", "select p_name, cast(count(*) as bigint) as copies from part group by p_name having count(*) > 1")
def duplicate_names(t: Tables) -> DataFrame:
    return R.duplicates(t.part, ["p_name"])


@query("U1", """
select p_name, min(p_partkey) as p_partkey, 'small' as origin from part where p_size <= 25 group by p_name
union all select p_name, min(p_partkey), 'large' from part where p_size > 25
  and p_name not in (select p_name from part where p_size <= 25) group by p_name
""")
def union_of_parts(t: Tables) -> DataFrame:
    small = t.part.filter("p_size <= 25").select("p_name", "p_partkey", F.lit("small").alias("origin"))
    large = t.part.filter("p_size > 25").select("p_name", "p_partkey", F.lit("large").alias("origin"))
    return R.union_by_key([small, large], ["p_name"])


@query("J12", """
with w as (select distinct p_type as wanted from part union select 'small ring' union select cast(p_partkey as varchar) from part where p_size = 1),
r as (
  select w.wanted, 0 as rank, cast(p_partkey as varchar) as key, p_name as name, p_type as type from part join w on w.wanted = p_name
  union all select w.wanted, 1, cast(p_partkey as varchar), p_name, p_type from part join w on w.wanted = p_type
  union all select w.wanted, 2, cast(p_partkey as varchar), p_name, p_type from part join w on w.wanted = cast(p_partkey as varchar))
select wanted, rank, key, name, type from r qualify row_number() over (partition by wanted order by rank, key, name, type) = 1
""")
def ranked_lookup(t: Tables) -> DataFrame:
    resources = t.part.select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name"), F.col("p_type").alias("type"))
    wanted = (
        t.part.select(F.col("p_type").alias("wanted"))
        .union(t.part.filter("p_size = 1").select(F.col("p_partkey").cast("string")))
        .union(t.part.filter("p_name = 'small ring'").select("p_name"))
    )
    return R.ranked_lookup(wanted, resources)


@query("F11 S16", """
select 'sym-' || p_partkey as name from part
where p_size % 5 <> 0 and p_size % 3 <> 0 and p_brand not in ('Brand#1', 'Brand#2')
""")
def publishable_symbols(t: Tables) -> DataFrame:
    table = F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), F.col("p_brand"))
    mib = t.part.select(
        F.concat(F.lit("sym-"), F.col("p_partkey").cast("string")).alias("name"),
        F.when(F.col("p_size") % 5 == 0, "obsolete").when(F.col("p_size") % 5 == 1, "current").alias("status"),
        (F.col("p_size") % 3 != 0).alias("readable"),
        table.alias("table_name"),
    )
    tables = t.part.select("p_brand").distinct().filter(F.col("p_brand").isin("Brand#1", "Brand#2")).select(
        F.col("p_brand").alias("name"), F.lit("current").alias("status"), F.lit(True).alias("readable"), F.lit(None).cast("string").alias("table_name")
    )
    return publishable(mib.unionByName(tables)).select("name")


@query("K3", """
with s as (select 'host-' || (s_suppkey % 2) as parent_key, s_suppkey // 2 as key, * from supplier),
old as (select parent_key, key, s_name as name, 'v' || (s_suppkey % 5) as version from s where s_suppkey % 4 <> 1),
new as (select parent_key, key, case when s_suppkey % 3 = 0 then null else upper(s_name) end as name, 'w' || (s_suppkey % 7) as version from s where s_suppkey % 4 <> 2)
select 'Server' as type, coalesce(new.parent_key, old.parent_key) as parent_key, coalesce(new.key, old.key) as key,
  coalesce(new.name, old.name) as name, coalesce(new.version, old.version) as version
from old full join new on old.key = new.key and old.parent_key = new.parent_key
""")
def inventory_upsert(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    keys = [
        F.lit("Server").alias("type"),
        F.concat(F.lit("host-"), (n % 2).cast("string")).alias("parent_key"),  # the same keys under two parents
        F.floor(n / 2).cast("bigint").alias("key"),
    ]
    old = t.supplier.filter(n % 4 != 1).select(*keys, F.col("s_name").alias("name"), F.concat(F.lit("v"), (n % 5).cast("string")).alias("version"))
    new = t.supplier.filter(n % 4 != 2).select(
        *keys, F.when(n % 3 != 0, F.upper("s_name")).alias("name"), F.concat(F.lit("w"), (n % 7).cast("string")).alias("version")
    )
    return upsert_inventory(old, new)


@query("A14", "select o_orderpriority, o_orderstatus, cast(count(*) as bigint) as runs from orders group by all")
def status_totals(t: Tables) -> DataFrame:
    return totals(t.orders, "o_orderstatus", ["o_orderpriority"])


@query("A15", """
select source, cast(count(*) as bigint) as count, cast(sum(n_chars) as bigint) as size, round(avg(n_chars), 4) as avg_size from documents group by source
""")
def collection_stats(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(
        F.count(F.lit(1)).alias("count"), F.sum("n_chars").alias("size"), F.round(F.avg("n_chars"), 4).alias("avg_size")
    )


@query("A6", """
select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as quantity, cast(sum(l_linenumber) as bigint) as numbers,
  cast(sum(l_partkey) as bigint) as parts, cast(sum(l_suppkey) as bigint) as suppliers, cast(count(*) as bigint) as rows
from lineitem group by all
""")
def column_sums(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.sum("l_linenumber").cast("bigint").alias("numbers"),
        F.sum("l_partkey").alias("parts"), F.sum("l_suppkey").alias("suppliers"), F.count(F.lit(1)).alias("rows"),
    )


@query("A8", """
select user_id, round(count(*) filter (event_type = 'error') / nullif(count(*) filter (event_type = 'signup' and value > 100), 0), 6) as ratio
from events group by user_id
""")
def guarded_ratio(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    counts = t.events.groupBy("user_id").agg(
        F.count_if(kind == "error").alias("part"), F.count_if((kind == "signup") & (F.col("value") > 100)).alias("whole")
    )
    return counts.select("user_id", F.round(C.ratio(F.col("part"), F.col("whole")), 6).alias("ratio"))


@query("A9", "select distinct lang, source from documents")
def distinct_sets(t: Tables) -> DataFrame:
    return t.documents.select("lang", "source").distinct()


@query("L2 A10 J2 D4", """
select n_name as tbl_name, cast(count(*) as bigint) as partitions from nation join customer on n_nationkey = c_nationkey
group by n_name order by n_name limit 1000
""")
def metastore_tables(t: Tables) -> DataFrame:
    tables = t.nation.select(F.col("n_nationkey").alias("tbl_id"), F.col("n_name").alias("tbl_name"))
    partitions = t.customer.select(F.col("c_nationkey").alias("tbl_id"), F.col("c_custkey").alias("sd_id"))
    return tables_with_partitions(tables, partitions, limit=1000)


@query("J2 S5 F5", """
select n_name as tbl_name, '/data/' || o_orderkey as location from nation join customer on n_nationkey = c_nationkey
join orders on o_custkey = c_custkey where n_name in ('NATION_3', 'NATION_17')
""")
def table_locations(t: Tables) -> DataFrame:
    tables = t.nation.select(F.col("n_nationkey").alias("tbl_id"), F.col("n_name").alias("tbl_name"))
    partitions = t.customer.select(F.col("c_nationkey").alias("tbl_id"), F.col("c_custkey").alias("sd_id"))
    storage = t.orders.select(F.col("o_custkey").alias("sd_id"), F.concat(F.lit("/data/"), F.col("o_orderkey").cast("string")).alias("location"))
    return locations(tables, partitions, storage, ["NATION_3", "NATION_17"])


@query("E41 A13", """
select p_type, p_brand, p_size, cast(count(*) as bigint) as copies from part group by all having count(*) > 1
""")
def duplicate_configurations(t: Tables) -> DataFrame:
    return R.duplicates(t.part, ["p_type", "p_brand", "p_size"])


@query("L4", """
select s_nationkey, s_suppkey from supplier qualify row_number() over (partition by s_nationkey order by s_suppkey) <= 3
""")
def first_three(t: Tables) -> DataFrame:
    w = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    return t.supplier.select("s_nationkey", "s_suppkey", F.row_number().over(w).alias("n")).filter("n <= 3").drop("n")


@query("K1 E9", """
select user_id as resource_key, event_type as metric, event_id, 'measurement' as data_type, strftime(ts, '%Y-%m-%d') as date, value as dvalue, null as svalue from events where event_type = 'click'
union all select user_id, event_type, event_id, 'trait', strftime(ts, '%Y-%m-%d'), null, 'v' || user_id from events where event_type = 'view'
""")
def report_sink(t: Tables) -> DataFrame:
    definitions = local_table(t.spark, [("click", "measurement"), ("view", "trait")], "metric STRING, data_type STRING")
    raw = F.when(F.col("event_type") == "view", F.concat(F.lit(" v"), F.col("user_id").cast("string"))).otherwise(F.col("value").cast("string"))
    values = t.events.select(F.col("user_id").alias("resource_key"), "event_id", "ts", F.col("event_type").alias("metric"), raw.alias("value"))
    path = scratch_path(t.spark, "report")
    for _ in range(2):  # a run that is repeated replaces itself
        write_report(R.coerce(values, definitions).drop("error"), path, run="1")
    back = read_runs(t.spark, path)
    return back.select("resource_key", "metric", "event_id", "data_type", F.col("date").cast("string").alias("date"), "dvalue", "svalue")


@query("K2 W5", """
with r as (select conv_id, turn, role, lag(role, 1, 'none') over (partition by conv_id order by turn) as previous from conversations)
select 'Role' as type, 'conv-' || conv_id as source, 'INFO' as severity, previous || ' to ' || role as detail, turn from r where role <> previous
""")
def event_sink(t: Tables) -> DataFrame:
    changes = state_changes(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], ["turn"], "role", F.lit("none"))
    events = changes.select(
        F.lit("Role").alias("type"), F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("source"),
        F.timestamp_seconds("turn").alias("ts"), F.lit("INFO").alias("severity"), F.concat("previous", F.lit(" to "), "role").alias("detail"), "turn",
    )
    path = scratch_path(t.spark, "events")
    for _ in range(2):
        write_events(events, path, run="1")
    return read_runs(t.spark, path).select("type", "source", "severity", "detail", "turn")
