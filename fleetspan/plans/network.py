"""Queries on readings and traps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.functions import oid as O
from fleetspan.operators import events as EV
from fleetspan.operators import snmp as S
from fleetspan.plans.registry import Tables, query
from fleetspan.plans import inputs as I
from fleetspan.session import local_table


@query("J4 E31", f"""
with {I.LISTING_SQL},
d as (select distinct regexp_extract(path, '^(/[^/]+)', 1) as prefix from listing union select distinct regexp_extract(path, '^(/[^/]+/[^/]+)', 1) from listing where page_id % 3 = 0),
c as (select page_id, path, prefix, row_number() over (partition by page_id order by length(prefix) desc) as n
  from listing join d on path = prefix or starts_with(path, prefix || '/') where prefix <> '')
select listing.page_id, listing.path, c.prefix, 'n:' || c.prefix as name from listing left join c on c.page_id = listing.page_id and n = 1
""")
def prefix_join(t: Tables) -> DataFrame:
    paths = I.listing(t).select("page_id", "path")
    hosts = paths.select(F.regexp_extract("path", r"^(/[^/]+)", 1).alias("entry"))
    deeper = paths.filter("page_id % 3 = 0").select(F.regexp_extract("path", r"^(/[^/]+/[^/]+)", 1).alias("entry"))
    dictionary = hosts.union(deeper).filter("entry <> ''").distinct().withColumn("name", F.concat(F.lit("n:"), "entry"))
    found = S.longest_prefix(paths, "path", dictionary, "entry", ["name"], "/")
    return found.select("page_id", "path", "prefix", "name")


@query("E31 J4 J9 S7", """
with v as (
  select event_id, 0 as pos, 'sysUpTime.0' as oid_name, cast(event_id as varchar) as text from events
  union all select event_id, 1, 'acmeText.0', event_type || ' of ' || user_id from events
  union all select event_id, 2, 'acmeState.0', case length(event_type) % 4 when 0 then 'idle' when 1 then 'busy' when 2 then 'failed' else '3' end from events
  union all select event_id, 3, 'acmeLoad.7.2', cast(event_id % 10 as varchar) from events
  union all select event_id, 4, '1.3.6.1.4.1.5.5', '1.3.6.1.2.1.1.3.0' from events)
select event_id, cast(pos as integer) as pos, case when pos = 4 then 'enterprises.5.5' else oid_name end as oid_name, text from v
""")
def variable_names(t: Tables) -> DataFrame:
    mib = I.mib(t)
    bound = I.traps(t).select(F.col("trap_id").alias("event_id"), F.posexplode("varbinds").alias("pos", "v")).select(
        "event_id", "pos", F.col("v.oid").alias("oid"), F.col("v.value").alias("value")
    )
    named = S.oid_names(bound, mib).withColumn("symbol", F.regexp_extract("oid_name", r"^([^.]*)", 1))
    coded = named.withColumn("code", F.col("value").try_cast("int"))
    labels = S.codes_table(mib).withColumnRenamed("name", "symbol")
    return coded.join(labels, ["symbol", "code"], "left").select(
        "event_id", "pos", "oid_name", F.coalesce("label", "value").alias("text")
    )


@query("E31", """
select event_id, 'sysUpTime.' || event_id as oid_name, '1.3.6.1.2.1.1.3.' || event_id as oid from events where event_id % 3 = 0
union all select event_id, '1.3.5.' || event_id, '1.3.5.' || event_id from events where event_id % 3 = 1
union all select event_id, 'nobody.1', null from events where event_id % 3 = 2
""")
def name_to_oid(t: Tables) -> DataFrame:
    n = F.col("event_id")
    name = F.when(n % 3 == 0, F.concat(F.lit("sysUpTime."), n.cast("string"))).when(n % 3 == 1, F.concat(F.lit("1.3.5."), n.cast("string"))).otherwise("nobody.1")
    return S.name_oids(t.events.select("event_id", name.alias("oid_name")), I.mib(t)).select("event_id", "oid_name", "oid")


_COLUMNS = [("1.3.6.1.4.1.900.7.1.1", "quantity"), ("1.3.6.1.4.1.900.7.1.2", "price"), ("1.3.6.1.4.1.900.7.1.3", "tax")]


def _cells(t: Tables) -> DataFrame:
    return S.table_cells(I.readings(t), local_table(t.spark, _COLUMNS, "oid STRING, name STRING"))


@query("J10 F8 S7", """
select cast(l_suppkey as varchar) as agent, l_orderkey || '.' || l_linenumber || '.' || l_partkey as row_index,
  max(cast(l_quantity as varchar)) as quantity, max(cast(l_extendedprice as varchar)) as price, max(cast(l_tax as varchar)) as tax
from lineitem where l_tax <> 0.08 group by all
""")
def row_assembly(t: Tables) -> DataFrame:
    return S.assemble_rows(_cells(t), ["agent", "row_index"], ["quantity", "price", "tax"])


@query("D8 E30", """
select distinct 'itemTable' as type, l_orderkey || '.' || l_linenumber || '.' || l_partkey as key,
  'order=' || l_orderkey || ', line=' || l_linenumber || ', part=' || l_partkey as name,
  'SNMP table itemTable, row index order=' || l_orderkey || ', line=' || l_linenumber || ', part=' || l_partkey as description,
  cast(l_suppkey as varchar) as parent_key
from lineitem where l_tax <> 0.08
""")
def row_resources(t: Tables) -> DataFrame:
    index = [("order", "int"), ("line", "int"), ("part", "int")]
    return S.row_resources(_cells(t), "itemTable", index).select("type", "key", "name", "description", "parent_key")


@query("E30", """
select p_partkey, p_name as name, cast(p_size as varchar) as size, '10.0.' || (p_size % 256) || '.1' as address, '7.' || p_partkey as rest from part
""")
def index_decode(t: Tables) -> DataFrame:
    # A name as its length and its bytes, then a number, an address and what remains.
    chars = F.transform(F.split(F.hex(F.encode("p_name", "UTF-8")), "(?<=\\G..)"), lambda h: F.conv(h, 16, 10).cast("bigint"))
    letters = F.filter(chars, lambda c: c.isNotNull())
    index = F.concat(
        F.array(F.size(letters).cast("bigint")), letters, F.array(F.col("p_size").cast("bigint")),
        F.array(F.lit(10), F.lit(0), (F.col("p_size") % 256).cast("bigint"), F.lit(1)), F.array(F.lit(7), F.col("p_partkey")),
    )
    decoded = O.decode_index(index, [("name", "string"), ("size", "int"), ("address", "ip"), ("rest", "other")])
    return t.part.select("p_partkey", decoded.alias("m")).select("p_partkey", *[F.col("m")[c].alias(c) for c in ("name", "size", "address", "rest")])


@query("J11 E14", """
select s.s_suppkey, s.s_name, n.n_name, cast(s.s_suppkey + cast(n.n_nationkey as hugeint) * 4294967296 as varchar) as capacity
from supplier s join nation n on s.s_nationkey = n.n_nationkey
""")
def correlated_tables(t: Tables) -> DataFrame:
    info = t.supplier.select(F.lit("a1").alias("agent"), F.col("s_nationkey").alias("device"), "s_suppkey", "s_name")
    extension = t.nation.select(F.lit("a1").alias("agent"), F.col("n_nationkey").alias("info_index"), "n_name")
    joined = S.correlated(info, extension, "agent", "device", "info_index")
    halves = joined.withColumns({"capL": F.col("s_suppkey").cast("string"), "capU": F.col("device").cast("string")})
    return S.composed_columns(halves, ["capL^capU"]).select("s_suppkey", "s_name", "n_name", F.col("capL^capU").cast("string").alias("capacity"))


@query("J5", """
with e as (select *, event_type in ('error', 'signup') as v1 from events)
select event_id,
  case when v1 and event_id % 7 = 3 and event_id % 4 = 2 then 'FATAL'
    when v1 and event_type = 'error' and regexp_matches(event_type || ' of ' || user_id, 'of .*7') then 'ERROR'
    when not v1 and regexp_matches(event_type || ' of ' || user_id, 'of .*7') then 'ERROR'
    when v1 and event_type = 'error' then 'WARN'
    when not v1 and event_id % 5 + 1 = 3 then 'WARN'
    when length(event_type) % 4 = 1 then 'DEBUG'
    else 'INFO' end as severity
from e
""")
def rule_classify(t: Tables) -> DataFrame:
    rules = [
        EV.Rule("FATAL", generic=3, specific=2, varbind="1.3.6.1.4.1.900.2.1", value="^(error|signup)"),
        EV.Rule("ERROR", enterprise="1.3.6.1.4.1.900", varbind="1.3.6.1.4.1.900.2.1", value="of .*7"),
        EV.Rule("WARN", enterprise="1.3.6.1.4.1.900", trap_oid="1.3.6.1.6.3.1.1.5.3"),
        EV.Rule("DEBUG", varbind="1.3.6.1.4.1.900.2.2", value="^1$", trap_oid="1.3.6.1.6.3.1.1.5"),
    ]
    return EV.classify(I.traps(t), rules).select(F.col("trap_id").alias("event_id"), "severity")


TRAP_RULES = [
    EV.Rule("ERROR", enterprise="1.3.6.1.4.1.900", varbind="1.3.6.1.4.1.900.2.1", value="^error"),
    EV.Rule("WARN", trap_oid="1.3.6.1.6.3.1.1.5.3", varbind="1.3.6.1.4.1.900.2.1", value="^(view|click)"),
]

TRAP_EVENTS_SQL = r"""
select case when event_id % 37 <> 0 then event_id end as trap_id, event_type || ' of ' || user_id as source, (epoch_us(ts) // 1000) as ms,
  case when event_type = 'error' then 'ERROR' when event_type in ('view', 'click') and event_id % 5 + 1 = 3 then 'WARN' else 'INFO' end as severity,
  regexp_replace(
    case when event_type in ('error', 'signup') then
      'Traptype (generic, specific): ' || (event_id % 7) || ', ' || (event_id % 4) || chr(10) ||
      'Timestamp: ' || case when event_id // 86400 = 0 then '' when event_id // 86400 = 1 then '1 day, ' else (event_id // 86400) || ' days, ' end ||
        (event_id // 3600 % 24) || ':' || lpad(cast(event_id // 60 % 60 as varchar), 2, '0') || ':' || lpad(cast(event_id % 60 as varchar), 2, '0') || '.00' || chr(10) ||
      'Enterprise: ' || case event_type when 'error' then 'acmeTraps' else 'enterprises.77' end || chr(10)
    else '' end ||
    'acmeText: ' || event_type || ' of ' || user_id || chr(10) ||
    'acmeState: ' || case length(event_type) % 4 when 0 then 'idle' when 1 then 'busy' when 2 then 'failed' else '3' end || chr(10) ||
    'acmeLoad.7.2: ' || (event_id % 10) || chr(10) ||
    'enterprises.5.5: sysUpTime.0' || chr(10), ' of [0-9]+', '', 'g') as detail
from events
"""


def decode(traps: DataFrame, mib: DataFrame) -> DataFrame:
    """Decoded events of traps, as both the batch query and the stream make them.

    Some traps are delivered twice and some come without an id.
    """
    number = F.col("trap_id")
    times = F.when(number % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    delivered = traps.withColumn("_time", F.explode(times)).drop("_time").withColumn("trap_id", F.when(number % 37 != 0, number))
    events = EV.decode_traps(
        delivered, mib, TRAP_RULES, omitted=["1.3.6.1.2.1.1.3.0"], pattern=" of [0-9]+", source_oid="1.3.6.1.4.1.900.2.1"
    )
    return events.select("trap_id", "source", F.unix_millis("ts").alias("ms"), "severity", "detail")


@query("T1 J4 J5 J9 F7 E37 E38 E43 S6", TRAP_EVENTS_SQL)
def trap_events(t: Tables) -> DataFrame:
    return decode(I.traps(t), I.mib(t))


@query("E43", """
select event_id, case when user_id % 5 = 0 then 'snmp-agent' when user_id % 3 <> 0 then 'host-' || user_id else '10.0.0.' || user_id end as source from events
""")
def trap_sources(t: Tables) -> DataFrame:
    return I.traps(t).select(F.col("trap_id").alias("event_id"), EV.trap_source().alias("source"))
