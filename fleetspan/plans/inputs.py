"""Domain tables derived from the given ones, every row of them.

Each derivation has an SQL text of the same rows, which the SQL twins of the
queries use as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.operators.skew import with_running_sum
from fleetspan.plans.registry import Tables
from fleetspan.schema import MIB
from fleetspan.session import local_table


def responses(t: Tables) -> DataFrame:
    """Pages as captured responses."""
    n = F.col("page_id")
    return t.pages.select(
        F.col("url").alias("resource_key"),
        F.col("page_id"),
        F.when(n % 11 == 3, 500).when(n % 13 == 5, 404).otherwise(200).alias("code"),
        F.create_map(
            F.lit("Server"), F.array(F.concat(F.lit("srv/"), n.cast("string"))),
            F.lit("x-head"), F.array((n * 3).cast("string"), F.lit("later")),
        ).alias("headers"),
        F.col("html").alias("body"),
        (n * 37 % 500).alias("elapsed_ms"),
        F.length("html").cast("bigint").alias("content_length"),
        (n * 1000 + 1700000000000).alias("last_modified"),
    )


RESPONSES_SQL = """
responses as (
  select url as resource_key, page_id, html as body,
    case when page_id % 11 = 3 then 500 when page_id % 13 = 5 then 404 else 200 end as code,
    cast(page_id as varchar) as id_text, page_id * 37 % 500 as elapsed_ms,
    length(html) as content_length, page_id * 1000 + 1700000000000 as last_modified
  from pages)
"""


def counters(t: Tables) -> DataFrame:
    """Running counts of clicks (hits) and errors (misses) per user, starting again every day."""
    e = t.events.select("user_id", "event_id", "ts", F.to_date("ts").alias("day"), "event_type")
    counted = with_running_sum(
        e, ["user_id", "day"], ["ts", "event_id"],
        {
            "hits": F.when(F.col("event_type") == "click", 1).otherwise(0).cast("bigint"),
            "misses": F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint"),
        },
    )
    return counted.drop("day", "event_type")


COUNTERS_SQL = """
counters as (
  select user_id, event_id, ts,
    cast(sum(case when event_type = 'click' then 1 else 0 end) over w as bigint) as hits,
    cast(sum(case when event_type = 'error' then 1 else 0 end) over w as bigint) as misses
  from events
  window w as (partition by user_id, cast(ts as date) order by ts, event_id rows between unbounded preceding and current row))
"""


def job_runs(t: Tables) -> DataFrame:
    """Orders as runs of jobs: finished ones end some days after they were created."""
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.concat(F.lit("job-"), F.col("o_custkey").cast("string")).alias("app_name"),
        F.col("o_orderkey").alias("run_id"),
        F.when(status == "F", "SUCCEEDED").when(status == "O", "RUNNING").otherwise("KILLED").alias("status"),
        F.col("o_orderdate").alias("created_time"),
        F.when(status != "O", F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 30).cast("int"))).alias("end_time"),
    )


JOB_RUNS_SQL = """
job_runs as (
  select 'job-' || o_custkey as app_name, o_orderkey as run_id,
    case o_orderstatus when 'F' then 'SUCCEEDED' when 'O' then 'RUNNING' else 'KILLED' end as status,
    o_orderdate as created_time,
    case when o_orderstatus <> 'O' then o_orderdate + to_days(cast(o_orderkey % 30 as integer)) end as end_time
  from orders)
"""


def attributes(t: Tables) -> DataFrame:
    """Events as bean attributes: numbered beans of each kind."""
    bean = F.concat(F.lit("stage.type="), F.col("event_type"), F.lit("-"), F.col("user_id").cast("string"))
    return t.events.select(
        F.col("event_id"), bean.alias("bean"), F.lit("amount").alias("attribute"), F.col("value").cast("string").alias("value"), "ts"
    )


ATTRIBUTES_SQL = """
attributes as (
  select event_id, 'stage.type=' || event_type || '-' || user_id as bean, 'amount' as attribute, value as number, ts
  from events)
"""


def listing(t: Tables) -> DataFrame:
    """Pages as a file listing: host and path steps as the path, page size as the length."""
    path = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace("url", r"^[a-z]+://", ""), r"[?#].*$", ""))
    return t.pages.select(
        "page_id",
        F.regexp_replace(path, "/+$", "").alias("path"),
        F.length("html").cast("bigint").alias("length"),
        F.timestamp_millis(F.col("page_id") * 1000 + 1700000000000).alias("mtime"),
        F.lit(False).alias("is_dir"),
        (F.col("page_id") % 17 != 0).alias("readable"),
    )


LISTING_SQL = r"""
listing as (
  select page_id,
    regexp_replace('/' || regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), '/+$', '') as path,
    length(html) as length, page_id * 1000 + 1700000000000 as mtime_ms, page_id % 17 <> 0 as readable
  from pages)
"""


def traps(t: Tables) -> DataFrame:
    """Events as traps: errors and signups as version 1, the rest as version 2."""
    kind = F.col("event_type")
    is_v1 = kind.isin("error", "signup")

    def bind(oid, var_type: str, value):
        return F.struct(F.lit(oid).alias("oid"), F.lit(var_type).alias("type"), value.cast("string").alias("value"))

    return t.events.select(
        F.col("event_id").alias("trap_id"),
        "ts",
        F.when(is_v1, 1).otherwise(2).alias("version"),
        (F.col("user_id") % 5 != 0).alias("peer_is_ip"),
        F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("host-"), F.col("user_id").cast("string"))).alias("peer_host"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("peer_address"),
        F.when(is_v1, (F.col("event_id") % 7).cast("int")).alias("generic"),
        F.when(is_v1, (F.col("event_id") % 4).cast("int")).alias("specific"),
        F.when(kind == "error", "1.3.6.1.4.1.900.1").when(kind == "signup", "1.3.6.1.4.1.77").alias("enterprise"),
        F.when(is_v1, F.col("event_id") * 100).alias("uptime_ticks"),
        F.when(~is_v1, F.concat(F.lit("1.3.6.1.6.3.1.1.5."), (F.col("event_id") % 5 + 1).cast("string"))).alias("trap_oid"),
        F.array(
            bind("1.3.6.1.2.1.1.3.0", "TimeTicks", F.col("event_id")),
            bind("1.3.6.1.4.1.900.2.1.0", "OctetString", F.concat(kind, F.lit(" of "), F.col("user_id").cast("string"))),
            bind("1.3.6.1.4.1.900.2.2.0", "Integer32", F.length(kind) % 4),
            bind("1.3.6.1.4.1.900.2.3.7.2", "Gauge32", F.col("event_id") % 10),
            bind("1.3.6.1.4.1.5.5", "OID", F.lit("1.3.6.1.2.1.1.3.0")),
        ).alias("varbinds"),
    )


# A dictionary for the identifiers above: (name, oid, codes).
MIB_ROWS = [
    ("sysUpTime", "1.3.6.1.2.1.1.3", {}),
    ("acme", "1.3.6.1.4.1.900", {}),
    ("acmeTraps", "1.3.6.1.4.1.900.1", {}),
    ("acmeText", "1.3.6.1.4.1.900.2.1", {}),
    ("acmeState", "1.3.6.1.4.1.900.2.2", {0: "idle", 1: "busy", 2: "failed"}),
    ("acmeLoad", "1.3.6.1.4.1.900.2.3", {}),
    ("enterprises", "1.3.6.1.4.1", {}),
]


def mib(t: Tables) -> DataFrame:
    rows = [(n, o, "Integer32", True, "current", c, None, n, None) for n, o, c in MIB_ROWS]
    return local_table(t.spark, rows, MIB)


def readings(t: Tables) -> DataFrame:
    """Line items as table readings: one column identifier per measure, order and line as the row index."""
    columns = {1: "l_quantity", 2: "l_extendedprice", 3: "l_tax"}
    cells = F.array(
        *[
            F.struct(
                F.concat(
                    F.lit(f"1.3.6.1.4.1.900.7.1.{n}."), F.col("l_orderkey").cast("string"), F.lit("."),
                    F.col("l_linenumber").cast("string"), F.lit("."), F.col("l_partkey").cast("string"),
                ).alias("oid"),
                F.col(c).cast("string").alias("value"),
            )
            for n, c in columns.items()
        ]
    )
    return (
        t.lineitem.select(F.col("l_suppkey").cast("string").alias("agent"), "l_tax", F.explode(cells).alias("_c"))
        .select("agent", F.col("_c.oid").alias("oid"), F.col("_c.value").alias("value"), (F.col("l_tax") == 0.08).alias("is_exception"))
    )


def processes(t: Tables) -> DataFrame:
    """Customers as process snapshots, one kind of server per market segment."""
    n = F.col("c_custkey").cast("string")
    port = (F.col("c_custkey") % 5000 + 2000).cast("string")
    segment = F.col("c_mktsegment")
    argv = (
        F.when(segment == "AUTOMOBILE", F.array(F.lit("/usr/bin/memcached"), F.lit("-d"), F.lit("-p"), port))
        .when(segment == "BUILDING", F.array(F.lit("/usr/bin/java"), F.concat(F.lit("-Doozie.http.port="), port), F.lit("-Doozie.http.hostname=wf"), F.lit("Boot")))
        .when(segment == "FURNITURE", F.array(F.lit("mongod"), F.lit("--bind_ip"), F.lit("10.1.1.1,127.0.0.1"), F.lit("--port"), port))
        .when(segment == "HOUSEHOLD", F.array(F.lit("redis-server"), F.lit("conf/redis.conf"), F.lit("--port"), port))
        .otherwise(F.array(F.lit("java"), F.lit("-cp"), F.concat(F.lit("/opt/lib/hadoop-core-0.20."), n, F.lit(".jar")), F.lit("org.apache.hadoop.mapred.TaskTracker")))
    )
    return t.customer.select(
        F.concat(F.lit("node-"), F.col("c_nationkey").cast("string")).alias("host"),
        F.col("c_custkey").alias("pid"),
        F.regexp_extract(F.element_at(argv, 1), r"([^/]+)$", 1).alias("basename"),
        argv.alias("argv"),
        F.lit("/srv").alias("cwd"),
        F.create_map(F.lit("HOME"), F.lit("/root")).alias("env"),
        F.lit(None).cast("string").alias("pidfile"),
    )


def server_processes(t: Tables) -> DataFrame:
    """Customers as processes of every server kind, with the ways their ports and versions are stated, and of no server."""
    n = F.col("c_custkey").cast("string")
    port = (F.col("c_custkey") % 5000 + 2000).cast("string")
    commands = [
        ["/usr/bin/memcached", "-l", F.concat(F.lit("10.2.2.2:"), port)],
        ["/usr/bin/java", F.concat(F.lit("-Doozie.base.url=http://wf"), n, F.lit(":11001/oozie")), F.concat(F.lit("-Doozie.http.port="), port)],
        ["mongod", "--config", "/etc/m.conf"],
        ["redis-server", "--port", port, "conf/redis.conf"],
        ["redis-server", F.concat(F.lit("/etc/redis-"), n, F.lit(".conf"))],
        [F.concat(F.lit("/app/product/11.2."), n, F.lit("/TimesTen/db"), port, F.lit("/bin/ttcserver")), "-verbose", "-p", port],
        ["/opt/ix/bin/splunkd", "-p", port, "start"],
        ["java", "-cp", F.concat(F.lit("/opt/lib/flume-ng-core-1."), n, F.lit(".jar")), "org.apache.flume.node.Application", "-n", "a1"],
        ["/bin/bash", "-p", port],
    ]
    kind = F.col("c_custkey") % len(commands)
    argv = F.lit(None).cast("array<string>")
    for i, words in enumerate(commands):
        argv = F.when(kind == i, F.array(*[F.lit(w) if isinstance(w, str) else w for w in words])).otherwise(argv)
    return t.customer.select(
        F.concat(F.lit("node-"), F.col("c_nationkey").cast("string")).alias("host"),
        F.col("c_custkey").alias("pid"),
        F.regexp_extract(F.element_at(argv, 1), r"([^/]+)$", 1).alias("basename"),
        argv.alias("argv"),
        F.concat(F.lit("/srv/"), n).alias("cwd"),
        F.create_map(F.lit("SPLUNK_HOME"), F.concat(F.lit("/opt/ix"), n)).alias("env"),
        F.lit(None).cast("string").alias("pidfile"),
    )


def server_files(t: Tables) -> DataFrame:
    """Configuration files of the key-value servers among ``server_processes``; some state no port, the absolute ones of odd customers were not captured."""
    n = F.col("c_custkey").cast("string")
    relative = F.col("c_custkey") % 9 == 3
    path = F.when(relative, F.concat(F.lit("/srv/"), n, F.lit("/conf/redis.conf"))).otherwise(F.concat(F.lit("/etc/redis-"), n, F.lit(".conf")))
    line = F.when(F.col("c_custkey") % 5 == 0, F.lit("bind 0.0.0.0")).otherwise(F.concat(F.lit("port "), (F.col("c_custkey") % 7000 + 10000).cast("string")))
    return t.customer.filter("c_custkey % 9 = 3 or (c_custkey % 9 = 4 and c_custkey % 2 = 0)").select(
        F.concat(F.lit("node-"), F.col("c_nationkey").cast("string")).alias("host"),
        path.alias("path"),
        F.concat(F.lit("# file\n"), line, F.lit("\nport 1\n")).alias("body"),
    )


def stated_configs(t: Tables) -> DataFrame:
    """Customers as configurations (host, kind, settings) of all kinds that are stated, some without the setting that counts."""
    n = F.col("c_custkey").cast("string")
    even = F.col("c_custkey") % 2 == 0
    kinds: list[tuple[str, dict[str, Column]]] = [
        ("device", {"address": F.concat(F.lit("udp:10.0.0."), n), "sys_name": F.col("c_name"), "sys_descr": F.concat(F.lit("Box NS9."), n, F.lit(": x"))}),
        ("resolver", {"server": F.concat(F.lit("10.9."), n)}),
        ("directory", {"directory": F.concat(F.when(even, F.lit("/data/")).otherwise(F.lit("data/")), n)}),
        ("path", {"url": F.concat(F.lit("hdfs://nn/"), n)}),
        ("checked path", {"path": F.when(even, F.concat(F.lit("/user/"), n))}),
        ("metadata server", {"url": F.concat(F.lit("jdbc:mysql://h"), n, F.lit("/m?user=u&password=p"))}),
        ("trap port", {"port": n}),
        ("log indexer", {"port": F.when(even, n), "version": F.lit("4.3")}),
        ("status page", {"url": F.concat(F.lit("http://h/"), n)}),
        ("queue page", {"url": F.concat(F.lit("http://j/"), n)}),
        ("configuration client", {"banner": F.when(even, F.concat(F.lit("vd 1."), n, F.lit(" built")))}),
        ("broker", {"port": n}),
    ]
    turn = F.col("c_custkey") % len(kinds)
    kind = F.element_at(F.array(*[F.lit(k) for k, _ in kinds]), (turn + 1).cast("int"))
    settings = F.lit(None).cast("map<string, string>")
    for i, (_, values) in enumerate(kinds):
        settings = F.when(turn == i, F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])).otherwise(settings)
    return t.customer.select(
        F.concat(F.lit("node-"), F.col("c_nationkey").cast("string")).alias("host"), kind.alias("kind"), settings.alias("settings")
    )


def config_documents(t: Tables) -> DataFrame:
    """Suppliers as configuration documents: host settings, two services, one of them switched off for some."""
    n = F.col("s_suppkey")

    def items(*values):
        return F.array(*[v if not isinstance(v, str) else F.lit(v) for v in values])

    service_a = F.struct(
        items(F.concat(F.lit("check "), F.col("s_name"))).alias("description"),
        items("1", ".0").alias("version"),
        items("-w", "5").alias("args"),
        F.struct(items("fast").alias("MODE")).alias("env"),
    )
    service_b = F.struct(
        items("q").alias("group"),
        items(F.when(n % 3 == 0, F.lit("false")).otherwise(F.lit("true"))).alias("enabled"),
    )
    monitor = F.struct(
        items("p").alias("group"),
        items("6", "0").alias("timeout"),
        F.struct(items("/bin").alias("PATH"), items("slow").alias("MODE")).alias("env"),
        F.struct(service_a.alias("alpha"), service_b.alias("beta")).alias("service"),
    )
    body = F.to_json(F.struct(F.struct(F.struct(monitor.alias("monitor")).alias("fleet")).alias("host")))
    return t.supplier.select(
        F.col("s_suppkey"), "s_name",
        F.regexp_replace(body, r'^\{"host":', F.concat(F.lit('{"'), F.lit("host-"), n.cast("string"), F.lit('":'))).alias("body"),
    )
