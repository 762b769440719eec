"""Queries over time: counters, samples, runs, instances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.operators import counters as CT
from fleetspan.operators import groups as G
from fleetspan.operators import jobs as J
from fleetspan.plans.registry import Tables, query
from fleetspan.plans import inputs as I
from fleetspan.session import local_table


@query("W2", f"""
with {I.COUNTERS_SQL},
d as (select user_id, ts, hits - lag(hits, 1, 0) over w as dh, misses - lag(misses, 1, 0) over w as dm from counters window w as (partition by user_id order by ts))
select user_id, cast(epoch_us(ts) as bigint) as us, round(dh / (dh + dm), 9) as ratio from d where dh >= 0 and dm >= 0 and dh + dm > 0
""")
def counter_ratio(t: Tables) -> DataFrame:
    ratios = CT.delta_ratio(I.counters(t), ["user_id"], "ts", "hits", "misses")
    return ratios.select("user_id", F.unix_micros("ts").alias("us"), F.round("ratio", 9).alias("ratio"))


@query("W3", f"""
with {I.COUNTERS_SQL},
d as (select user_id, ts, hits, hits - lag(hits) over w as step, (epoch_us(ts) - lag(epoch_us(ts)) over w) / 1e6 as seconds from counters window w as (partition by user_id order by ts))
select user_id, cast(epoch_us(ts) as bigint) as us, cast(case when step >= 0 then step when step < 0 then hits end as bigint) as delta,
  round(case when step >= 0 then step when step < 0 then hits end / seconds, 9) as rate from d
""")
def counter_rate(t: Tables) -> DataFrame:
    rates = CT.counter_rate(I.counters(t), ["user_id"], "ts", "hits")
    return rates.select("user_id", F.unix_micros("ts").alias("us"), "delta", F.round("rate", 9).alias("rate"))


@query("W6 A5", """
select event_id, cast(sum(case when event_type = 'error' then 1 else 0 end) over (partition by user_id order by event_id rows between unbounded preceding and current row) as bigint) as errors
from events
""")
def running_totals(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type")
    return CT.running_total(rows, ["user_id"], ["event_id"], F.col("event_type") == "error", "errors").select("event_id", "errors")


@query("A5", """
select event_type, cast(count(*) as bigint) as events, cast(count(*) filter (value > 100) as bigint) as large from events group by event_type
""")
def event_counts(t: Tables) -> DataFrame:
    return CT.totals(t.events, ["event_type"], events=F.lit(True), large=F.col("value") > 100)


@query("W8 T7", """
with i(metric, interval_ms) as (values ('click', 60000), ('view', 300000), ('error', 1200000), ('purchase', 3600000))
select user_id, metric, cast((epoch_us(ts) // 1000) // interval_ms * interval_ms as bigint) as bucket_ms, last(value order by ts, event_id) as value
from events join i on metric = event_type group by all
""")
def schedule_samples(t: Tables) -> DataFrame:
    intervals = local_table(
        t.spark, [("click", 60_000), ("view", 300_000), ("error", 1_200_000), ("purchase", 3_600_000)], "metric STRING, interval_ms BIGINT"
    )
    rows = t.events.select("event_id", "user_id", "ts", F.col("event_type").alias("metric"), "value")
    return CT.schedule_sample(rows, intervals, ["user_id"], tie=["event_id"])


@query("W4 E28 L3", f"""
with {I.JOB_RUNS_SQL},
r as (select *, row_number() over (partition by app_name order by created_time desc, run_id desc) as n from job_runs),
s as (select app_name, max(end_time) as success from job_runs where status = 'SUCCEEDED' and end_time is not null group by app_name)
select a.app_name, a.run_id, a.status, b.run_id as prior_run_id, b.status as prior_status,
  cast(epoch_ms(coalesce(a.end_time, timestamp '2002-01-01')) - epoch_ms(a.created_time) as bigint) as elapsed_ms,
  cast(epoch_ms(timestamp '2002-01-01') - epoch_ms(success) as bigint) as recency_ms, a.status in ('RUNNING', 'SUCCEEDED') as up
from r a left join r b on a.app_name = b.app_name and b.n = 2 left join s on s.app_name = a.app_name where a.n = 1
""")
def job_latest_prior(t: Tables) -> DataFrame:
    status = J.job_status(I.job_runs(t), F.lit("2002-01-01").cast("timestamp"))
    return status.select("app_name", "run_id", "status", "prior_run_id", "prior_status", "elapsed_ms", "recency_ms", "up")


@query("L3", """
select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as integer) as rank
from orders qualify rank <= 2
""")
def newest_per_job(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return J.newest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 2).select("o_custkey", "o_orderkey", "rank")


@query("L3 L2", "select o_orderkey, o_orderstatus from orders order by o_orderdate desc, o_orderkey desc limit 5000")
def newest_overall(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return J.newest_overall(rows, ["o_orderdate", "o_orderkey"], 5000).select("o_orderkey", "o_orderstatus")


@query("W1 L1 D3", """
select event_id, event_type || '|' || (row_number() over (partition by event_type order by cast(event_id as varchar)) - 1) as instance_key from events
""")
def instance_key(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type")
    return G.instance_keys(rows, "event_type", F.col("event_id")).select("event_id", "instance_key")


@query("A1 D9 S17", f"""
with {I.ATTRIBUTES_SQL}
select regexp_replace(bean, '-[0-9]+$', '*') as group_name, attribute, round(sum(number), 2) as value, cast(count(*) as bigint) as members
from attributes where bean like 'stage.type=%' group by all
""")
def group_sum(t: Tables) -> DataFrame:
    found = G.matching_beans(I.attributes(t), "stage.type=%kind%")
    sums = G.group_sum(found, G.group_name(F.col("bean")))
    return sums.select("group_name", "attribute", F.round("value", 2).alias("value"), "members")


@query("A1", """
select 'Customer*' as group_name, 'balance' as attribute, round(sum(c_acctbal), 2) as value, cast(count(*) as bigint) as members from customer
""")
def group_sum_customers(t: Tables) -> DataFrame:
    rows = t.customer.select(F.regexp_replace("c_name", "#", "-").alias("n"), F.lit("balance").alias("attribute"), F.col("c_acctbal").alias("value"))
    return G.group_sum(rows, G.group_name(F.col("n"))).select("group_name", "attribute", F.round("value", 2).alias("value"), "members")


@query("T2 W6", "select user_id, cast(count(*) as bigint) as n from events group by user_id")
def source_counts(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
