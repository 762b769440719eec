"""Queries on availability and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.operators.snmp import drop_exceptions, omit
from fleetspan.operators.snmp import error_reports as reports
from fleetspan.operators import availability as AV
from fleetspan.operators import config as CF
from fleetspan.operators import events as EV
from fleetspan.plans.registry import Tables, query
from fleetspan.plans import inputs as I
from fleetspan.session import local_table


@query("F1", f"""
with {I.RESPONSES_SQL}
select page_id, code, code = 200 as strict, true as any_code from responses
""")
def status_filter(t: Tables) -> DataFrame:
    code = F.col("code")
    return I.responses(t).select(
        "page_id", "code", AV.status_accepted(code, F.lit(200)).alias("strict"),
        AV.status_accepted(code, F.lit(None).cast("int")).alias("any_code"),
    )


@query("F2 X4", "select page_id from pages where regexp_matches(html, '<h1>[^<]*&amp;')")
def body_filter(t: Tables) -> DataFrame:
    return t.pages.filter(AV.body_accepted(F.col("html"), "<h1>[^<]*&amp;") & AV.body_accepted(F.col("html"), "")).select("page_id")


@query("F3 F1 F2", f"""
with {I.RESPONSES_SQL}
select resource_key, page_id as ts, code = 200 and regexp_matches(body, '&amp;') as up,
  case when code <> 200 then 'status ' || code when not regexp_matches(body, '&amp;') then 'body not matched' end as reason
from responses
""")
def availability_responses(t: Tables) -> DataFrame:
    code, body, ok = F.col("code"), F.col("body"), F.lit(200)
    rows = I.responses(t).withColumnRenamed("page_id", "ts")
    return AV.availability(
        rows, AV.response_up(code, body, ok, "&amp;"), reason=AV.response_reason(code, body, ok, "&amp;")
    )


@query("F3 A7", """
select user_id, strftime(ts, '%Y-%m-%d') as day, bool_and(event_type <> 'error') as up, cast(count(*) filter (event_type <> 'error') as bigint) as answers
from events group by all
""")
def availability_daily(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    return AV.all_up(rows, ["user_id", "day"], F.col("event_type") != "error")


@query("F3", """
select user_id, bool_or(event_type = 'purchase' and value > 100) as up from events group by user_id
""")
def availability_any(t: Tables) -> DataFrame:
    return AV.any_up(t.events, ["user_id"], (F.col("event_type") == "purchase") & (F.col("value") > 100))


@query("F3", """
select o_orderkey, o_orderstatus = 'O' as running, o_orderstatus = 'P' as active, o_orderstatus in ('F', 'O') as job_up,
  o_orderkey % 4 in (0, 1) as exit_up, o_orderkey % 5 <> 0 as answered, o_orderkey % 5 <> 0 or o_orderkey % 2 = 0 as fs_up
from orders
""")
def availability_states(t: Tables) -> DataFrame:
    status, n = F.col("o_orderstatus"), F.col("o_orderkey")
    state = F.when(status == "O", "RUNNING").when(status == "P", "ACTIVE").otherwise("SUCCEEDED")
    answer = F.when(n % 5 != 0, F.lit("x"))
    error = F.when(n % 2 == 0, F.lit("org.x.StandbyException: read refused")).otherwise("refused")
    return t.orders.select(
        "o_orderkey",
        AV.state_up(state, AV.RUNNING_STATES).alias("running"),
        AV.state_up(state, AV.ACTIVE_STATES).alias("active"),
        AV.state_up(state, AV.JOB_UP_STATES).alias("job_up"),
        AV.exit_up((n % 4).cast("int")).alias("exit_up"),
        AV.answered(answer).alias("answered"),
        AV.file_system_up(answer, error).alias("fs_up"),
    )


@query("F3", """
select event_id, user_id, ts >= min(case when event_type = 'signup' then ts end) over (partition by user_id) is true as up from events
""")
def availability_latched(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    return AV.latched_up(rows, ["user_id"], "ts", F.col("event_type") == "signup").select("event_id", "user_id", "up")


@query("F3", """
select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P') as up from customer
""")
def still_listed(t: Tables) -> DataFrame:
    listing = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return AV.still_listed(t.customer.select("c_custkey"), listing, ["c_custkey"])


@query("F3 F8", """
select user_id, arg_min(event_type <> 'error', event_id) as up from events group by user_id
""")
def first_reading_up(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", (F.col("event_type") == "error").alias("is_exception"))
    return AV.first_readable(rows, ["user_id"], "event_id")


@query("F4", "select s_suppkey from supplier where s_suppkey % 4 not in (0)")
def enabled_filter(t: Tables) -> DataFrame:
    n = F.col("s_suppkey") % 4
    flag = F.when(n == 0, "false").when(n == 1, F.lit(None)).otherwise("True")
    return t.supplier.filter(AV.enabled(flag)).select("s_suppkey")


@query("F5 D4", "select p_partkey, p_name from part where regexp_matches(p_name, 'r.d|ring$')")
def name_filter(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").rlike("r.d|ring$")).select("p_partkey", "p_name")


@query("F7", """
select event_id, oid from (
  select event_id, '1.3.6.1.2.1.1.3.0' as oid from events where false
  union all select event_id, '1.3.6.1.4.1.900.2.1.0' from events
  union all select event_id, '1.3.6.1.4.1.900.2.2.0' from events
  union all select event_id, '1.3.6.1.4.1.5.5' from events)
""")
def omitted_variables(t: Tables) -> DataFrame:
    bound = I.traps(t).select(F.col("trap_id").alias("event_id"), F.explode("varbinds").alias("v")).select("event_id", F.col("v.oid").alias("oid"))
    return omit(bound, local_table(t.spark, [("1.3.6.1.2.1.1.3",), ("1.3.6.1.4.1.900.2.3.7.2",)], "oid STRING"))


@query("F8", "select l_suppkey, l_orderkey, l_linenumber, l_partkey from lineitem where l_tax <> 0.08")
def readable_rows(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_tax") == 0.08).alias("is_exception"))
    return drop_exceptions(rows).drop("is_exception")


@query("F14", """
select user_id, cast(event_id as bigint) as event_id, case user_id % 2 when 0 then '1.3.6.1.6.3.15.1.1.2.0' else '1.3.6.1.6.3.15.1.1.3.0' end as oid,
  case user_id % 2 when 0 then 'usmStatsNotInTimeWindows' else 'usmStatsUnknownUserNames' end as error
from events where event_type = 'error'
""")
def error_reports(t: Tables) -> DataFrame:
    bad = F.when(F.col("user_id") % 2 == 0, "1.3.6.1.6.3.15.1.1.2.0").otherwise("1.3.6.1.6.3.15.1.1.3.0")
    oids = (
        F.when(F.col("event_type") == "error", F.array(bad))
        .when(F.col("event_type") == "click", F.array(bad, F.lit("1.3.6.1.2.1.1.3.0")))
        .otherwise(F.array(F.lit("1.3.6.1.2.1.1.3.0")))
    )
    return reports(t.events.select("user_id", "event_id", F.explode(oids).alias("oid")), ["user_id", "event_id"])


@query("W5 T4", """
with r as (select conv_id, turn, role, lag(role, 1, 'none') over (partition by conv_id order by turn) as previous from conversations)
select conv_id, turn, role, previous from r where role <> previous
""")
def state_changes(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", "role")
    return EV.state_changes(rows, ["conv_id"], ["turn"], "role", F.lit("none"))


@query("W5 F3", """
with c as (select user_id, ts, event_id, case event_type when 'error' then 2 when 'purchase' then 1 when 'signup' then 7 else 0 end as code from events),
r as (select *, lag(code, 1, 0) over (partition by user_id order by ts, event_id) as previous from c where code in (0, 1, 2))
select user_id, event_id, code, previous, case code when 0 then 'INFO' when 1 then 'WARN' else 'ERROR' end as severity,
  case when event_id % 2 = 0 then 'exit code ' || code else left('out ' || event_id || repeat('.', case when event_id % 10 = 5 then 1100 else 0 end), 1024) end as detail
from r where code <> previous
""")
def exit_events(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    code = F.when(kind == "error", 2).when(kind == "purchase", 1).when(kind == "signup", 7).otherwise(0)
    runs = t.events.select("user_id", "ts", "event_id", code.alias("code"))
    dots = F.repeat(F.lit("."), F.when(F.col("event_id") % 10 == 5, 1100).otherwise(0))
    output = F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("out "), F.col("event_id").cast("string"), dots))
    return EV.exit_events(runs, ["user_id"], ["ts", "event_id"], "code", output).select(
        "user_id", "event_id", "code", "previous", "severity", "detail"
    )


@query("J8 U1", """
with base as (select r_regionkey, r_name as label, 'r' || r_regionkey as zone from region)
select 'nation-' || n_nationkey as resource, 'label' as key, case when n_nationkey % 3 = 0 then n_name else label end as value from nation join base on n_regionkey = r_regionkey
union all select 'nation-' || n_nationkey, 'zone', zone from nation join base on n_regionkey = r_regionkey
union all select 'nation-' || n_nationkey, 'own', n_name from nation
""")
def config_overlay(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    resource = F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("resource")

    def pairs(**values):
        return F.explode(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])).alias("key", "value")

    base = joined.select(resource, pairs(label=F.col("r_name"), zone=F.concat(F.lit("r"), F.col("r_regionkey").cast("string"))))
    own = joined.select(resource, pairs(own=F.col("n_name")))
    labels = joined.filter(F.col("n_nationkey") % 3 == 0).select(resource, pairs(label=F.col("n_name")))
    # A null says nothing, so the base's value stays.
    silent = joined.filter(F.col("n_nationkey") % 5 == 1).select(resource, pairs(zone=F.lit(None).cast("string")))
    return CF.overlay(base, own.unionByName(labels).unionByName(silent), ["resource", "key"])


@query("E39 J8 F4 D7 S9", """
select 'host-' || s_suppkey as host, 'alpha' as service, 'p' as grp, '60' as timeout, '1.0' as version, 'true' as enabled,
  'fast' as mode, '/bin' as path, '-w 5' as args, 'check ' || s_name as description from supplier
union all select 'host-' || s_suppkey, 'beta', 'q', '60', null, 'true', 'slow', '/bin', '', null from supplier where s_suppkey % 3 <> 0
""")
def service_settings(t: Tables) -> DataFrame:
    services = CF.enabled_services(CF.service_settings(I.config_documents(t), "body", "fleet"))

    def setting(name: str):
        return F.try_element_at("settings", F.lit(name))

    return services.select(
        "host", "service", setting("group").alias("grp"), setting("timeout").alias("timeout"), setting("version").alias("version"),
        setting("enabled").alias("enabled"), setting("env.MODE").alias("mode"), setting("env.PATH").alias("path"),
        F.array_join("args", " ").alias("args"), setting("description").alias("description"),
    )


@query("W7", """
with s as (select o_custkey, o_orderkey, o_orderdate, o_orderstatus || o_orderpriority as content from orders),
r as (select *, lag(content) over (partition by o_custkey order by o_orderdate, o_orderkey) as before from s)
select o_custkey, o_orderkey, before is not null and before <> content as changed from r
""")
def config_changes(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.concat("o_orderstatus", "o_orderpriority").alias("content"))
    return CF.config_changes(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("content")).select("o_custkey", "o_orderkey", "changed")


@query("J8 F3", """
select 'host-' || s_suppkey as host, svc.service as service,
  case when svc.service = 'gone' then 'false' when svc.service = 'beta' and s_suppkey % 3 = 0 then 'false' else 'true' end as enabled, true as up
from supplier, (values ('alpha'), ('beta'), ('gone')) svc(service)
""")
def watched_services(t: Tables) -> DataFrame:
    services = CF.service_settings(I.config_documents(t), "body", "fleet")
    known = t.supplier.select(
        F.concat(F.lit("host-"), F.col("s_suppkey").cast("string")).alias("host"),
        F.explode(F.array(F.lit("alpha"), F.lit("beta"), F.lit("gone"))).alias("service"),
    )
    return CF.watched_services(known, services)
