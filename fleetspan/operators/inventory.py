"""Inventory: resources built from captured tables, merged and compared."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.urls import canonical_name, container_key, scrub_query
from fleetspan.functions import address as A
from fleetspan.operators.config import enabled_services
from fleetspan.operators.groups import group_name, instance_keys
from fleetspan.session import materialize


@dataclass(frozen=True)
class ResourceSpec:
    """How rows become resources of one type; every hook is a column."""

    type: str
    key: Column
    name: Column | None = None
    version: Column | None = None
    description: Column | None = None
    config: dict[str, Column] = field(default_factory=dict)
    parent_key: Column | None = None


def _resource(spec: ResourceSpec) -> Column:
    """A row's resource as a struct of inventory columns."""
    nothing = F.lit(None).cast("string")

    def text(c: Column | None) -> Column:
        return nothing if c is None else c.cast("string")

    pairs = [x for k, v in spec.config.items() for x in (F.lit(k), v.cast("string"))]
    config = F.create_map(*pairs) if pairs else F.create_map().cast("map<string, string>")
    return F.struct(
        F.lit(spec.type).alias("type"),
        spec.key.cast("string").alias("key"),
        text(spec.key if spec.name is None else spec.name).alias("name"),
        text(spec.version).alias("version"),
        text(spec.description).alias("description"),
        config.alias("config"),
        text(spec.parent_key).alias("parent_key"),
    )


def build_inventory(df: DataFrame, spec: ResourceSpec) -> DataFrame:
    """Inventory rows of a type, one per (type, parent, key)."""
    rows = df.select(_resource(spec).alias("_r")).select("_r.*")
    return one_per_key(rows.filter(F.col("key").isNotNull()))


def build_inventories(df: DataFrame, specs: Sequence[tuple[Column, ResourceSpec]]) -> DataFrame:
    """Inventory rows of many types in one scan and one aggregation: each row gives a resource per condition it meets."""
    candidates = F.array_compact(F.array(*[F.when(keep & spec.key.isNotNull(), _resource(spec)) for keep, spec in specs]))
    return one_per_key(df.select(F.inline(candidates)))


def one_per_key(rows: DataFrame) -> DataFrame:
    """One row per (type, parent, key); of several the smallest name, version and description count."""
    first = F.min_by(
        F.struct("name", "version", "description", "config"), F.struct("name", "version", "description")
    ).alias("_r")
    return rows.groupBy("type", "parent_key", "key").agg(first).select(
        "type", "key", F.col("_r.name").alias("name"), F.col("_r.version").alias("version"),
        F.col("_r.description").alias("description"), F.col("_r.config").alias("config"), "parent_key",
    )


def upsert_inventory(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("type", "parent_key", "key")) -> DataFrame:
    """Old and new resources by key: a new row replaces the old one's values it states.

    A resource is known by its type, parent and key, as in ``one_per_key``.
    """
    rest = [c for c in old.columns if c not in keys]
    ranked = old.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    return ranked.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in rest]).select(
        *old.columns
    )


def inventory_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Per key: ``added``, ``removed`` or ``changed``; equal ones are left out. Null is a key: a top resource has no parent."""
    def side(df: DataFrame, number: int, flag: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_key_{number}_{i}") for i, k in enumerate(keys)], F.struct(*[F.col(c) for c in compared]).alias(flag))

    old, new = side(before, 0, "_before"), side(after, 1, "_after")
    same = reduce(lambda a, b: a & b, [old[f"_key_0_{i}"].eqNullSafe(new[f"_key_1_{i}"]) for i in range(len(keys))])
    gone = F.col("_after").isNull()
    both = old.join(new, same, "full_outer").select(
        *[F.when(gone, F.col(f"_key_0_{i}")).otherwise(F.col(f"_key_1_{i}")).alias(k) for i, k in enumerate(keys)], "_before", "_after"
    )
    status = (
        F.when(F.col("_before").isNull(), "added")
        .when(F.col("_after").isNull(), "removed")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "changed")
    )
    return both.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_before", "_after")


def rebind(known: DataFrame, current: DataFrame, on: str = "name", id_column: str = "id") -> DataFrame:
    """Known resources with the id their name has now; one that is gone keeps its old id and is down."""
    now = current.groupBy(on).agg(F.max(id_column).alias("_now"))
    return (
        known.join(now, on, "left")
        .withColumns({"up": F.col("_now").isNotNull(), id_column: F.coalesce("_now", id_column)})
        .drop("_now")
    )


# --- builders ---------------------------------------------------------------


def url_resources(responses: DataFrame, resource_type: str, accept: Column, url: str = "resource_key") -> DataFrame:
    """A resource per URL that answered as expected."""
    key = F.col(url)
    return build_inventory(
        responses.filter(accept),
        ResourceSpec(resource_type, key, F.concat(F.lit(f"{resource_type} "), key), config={"url": key}),
    )


def port_resources(df: DataFrame, body: str, pattern: str = A.PORT_LINE, parent: str | None = None) -> DataFrame:
    """A resource per address harvested from configuration lines."""
    keep = [parent] if parent else []
    found = A.harvest(df, body, keep, pattern).withColumn("_a", A.parse_address(F.col("address")))
    name = F.concat(F.lit("port "), F.col("address"))
    return build_inventory(
        found.filter(F.col("_a.port").isNotNull()),
        ResourceSpec(
            "Port", F.col("address"), name, description=name,
            config={"host": F.col("_a.host"), "port": F.col("_a.port")},
            parent_key=F.col(parent) if parent else None,
        ),
    )


def application_resources(apps: DataFrame) -> DataFrame:
    """Streaming applications by name (name, version)."""
    clean = canonical_name(F.col("name"))
    return build_inventory(
        apps,
        ResourceSpec(
            "Application", F.col("name"), clean, A.build_version(F.col("version")),
            F.concat(F.lit("Application "), clean),
        ),
    )


def container_resources(containers: DataFrame, parent: str = "app") -> DataFrame:
    """Containers by the tail of their id (id, app)."""
    key = container_key(F.col("id"))
    return build_inventory(
        containers,
        ResourceSpec("Container", key, F.concat(F.lit("c_"), key), description=F.concat(F.lit("Container "), key), parent_key=F.col(parent)),
    )


def operator_resources(operators: DataFrame, parent: str = "app") -> DataFrame:
    """Operators by name and instance number (id, name, app)."""
    keyed = instance_keys(operators, "name", F.col("id"), [parent])
    return build_inventory(
        keyed,
        ResourceSpec("Operator", F.col("instance_key"), F.col("name"), description=F.concat(F.lit("Operator "), F.col("name")), parent_key=F.col(parent)),
    )


def operator_counter_resources(operators: DataFrame, pattern: str, parent: str = "app") -> DataFrame:
    """One counters resource per operator name that the pattern covers whole."""
    return build_inventory(
        operators.filter(F.col("name").rlike(f"^(?:{pattern})$")),
        ResourceSpec("OperatorCounters", F.col("name"), parent_key=F.col(parent)),
    )


def table_resources(tables: DataFrame, pattern: str = ".*", name: str = "name") -> DataFrame:
    """Tables whose name holds the pattern."""
    key = F.col(name)
    return build_inventory(
        tables.filter(key.rlike(pattern)), ResourceSpec("Table", key, key, description=F.concat(F.lit("Table "), key))
    )


def job_resources(runs: DataFrame, resource_type: str, name: str) -> DataFrame:
    """One resource per job name, however many runs it has."""
    return build_inventory(runs, ResourceSpec(resource_type, F.col(name)))


def database_resources(databases: DataFrame, collections: DataFrame) -> DataFrame:
    """Databases (server, name, master) and, below masters only, their collections (server, database, name)."""
    tops = build_inventory(databases, ResourceSpec("Database", F.col("name"), parent_key=F.col("server")))
    masters = databases.filter("master").select("server", F.col("name").alias("database")).distinct()
    below = build_inventory(
        collections.join(masters, ["server", "database"], "left_semi"),
        ResourceSpec("Collection", F.col("name"), parent_key=F.concat_ws("/", "server", "database")),
    )
    return tops.unionByName(below)


def service_resources(services: DataFrame) -> DataFrame:
    """Enabled services (host, service, settings) with version and description from their settings."""
    s = F.col("settings")
    return build_inventory(
        enabled_services(services),
        ResourceSpec(
            "Service", F.col("service"), version=F.try_element_at(s, F.lit("version")),
            description=F.try_element_at(s, F.lit("description")), parent_key=F.col("host"),
        ),
    )


def bean_group_resources(attributes: DataFrame, name: str = "bean", resource_type: str = "Group") -> DataFrame:
    """One resource per group of like-named beans."""
    return build_inventory(
        attributes.select(group_name(F.col(name)).alias("_g")).filter(F.col("_g").isNotNull()),
        ResourceSpec(resource_type, F.col("_g"), F.replace(F.col("_g"), F.lit("*"), F.lit(""))),
    )


@dataclass(frozen=True)
class ProcessQuery:
    """Which processes belong to a server: base name and argument patterns, or a pid file."""

    basename: str | None = None
    argument: str | None = None
    argument_value: str = ".*"
    pidfile: str | None = None


# Process queries by server kind.
PROCESS_QUERIES = {
    "stream gateway": ProcessQuery("^java.*", "com.datatorrent.gateway.DTGateway"),
    "key-value": ProcessQuery("^redis-server.*"),
    "workflow boot": ProcessQuery("^java.*", "/usr/lib/oozie/oozie-server/bin/bootstrap.jar"),
    "workflow port": ProcessQuery("^java.*", "-Doozie.http.port"),
    "workflow pid": ProcessQuery(pidfile="/var/run/oozie/oozie.pid"),
    "document": ProcessQuery("^mongod.*"),
    "collector pid": ProcessQuery(pidfile="/var/run/flume-ng/flume-ng-agent.pid"),
    "collector": ProcessQuery("^java.*", "-cp", ".*/flume-ng/.*"),
    "cache": ProcessQuery("^memcached.*"),
    "log indexer": ProcessQuery("^splunkd.*", "-p"),
}


def selected(query: ProcessQuery) -> Column:
    """Whether a query selects a process; an argument is matched with its value, joined by ``=`` or following."""
    keep = F.lit(True)
    if query.pidfile is not None:
        keep &= F.coalesce(F.col("pidfile") == query.pidfile, F.lit(False))
    if query.basename is not None:
        keep &= F.coalesce(F.col("basename").rlike(query.basename), F.lit(False))
    if query.argument is not None:
        name, whole = query.argument, f"^(?:{query.argument_value})$"
        following = A.argument_after(F.col("argv"), name)
        inline = F.exists(
            "argv",
            lambda a: a.startswith(name + "=") & F.substring(a, len(name) + 2, 1 << 30).rlike(whole),
        )
        alone = F.array_contains("argv", name) & F.coalesce(following, F.lit("")).rlike(whole)
        keep &= F.coalesce(inline | alone, F.lit(False))
    return keep


def process_scan(processes: DataFrame, query: ProcessQuery) -> DataFrame:
    """Processes a query selects."""
    return processes.filter(selected(query))


def _basename(pattern: str) -> Column:
    return F.coalesce(F.col("basename").rlike(pattern), F.lit(False))


def _server_kinds(conf_port: Column) -> dict[str, tuple[Column, ResourceSpec]]:
    """By kind: which processes are servers of it, and how such a server is keyed: by type, port, URL or address."""
    argv, host = F.col("argv"), F.col("host")

    def listening(resource_type: str, at: Column) -> ResourceSpec:
        key = F.concat_ws(":", at["host"], at["port"].cast("string"))
        return ResourceSpec(resource_type, key, config={"host": at["host"], "port": at["port"]}, parent_key=host)

    url = A.workflow_url(argv)
    url_port = F.regexp_extract(url, r":(\d+)", 1)
    store_port = A.key_store_port_of(argv, conf_port)
    store = F.concat(F.lit("key-value "), store_port.cast("string"))
    who = A.database_identity(argv)
    index_port = A.argument_after(argv, "-p")
    main = F.regexp_extract(A.java_main(argv), r"^\S*?([^.\s]+)(?:\s|$)", 1)
    return {
        "workflow": (
            selected(PROCESS_QUERIES["workflow port"]) | selected(PROCESS_QUERIES["workflow boot"]),
            ResourceSpec(
                "WorkflowServer", url, F.concat(F.lit("WorkflowServer:"), url_port),
                description=F.concat(F.lit("Workflow service "), url_port), config={"url": url}, parent_key=host,
            ),
        ),
        "cache": (selected(PROCESS_QUERIES["cache"]), listening("CacheServer", A.cache_address(argv))),
        "document": (selected(PROCESS_QUERIES["document"]), listening("DocumentServer", A.document_server_address(argv))),
        "key-value": (
            selected(PROCESS_QUERIES["key-value"]),
            ResourceSpec(
                "KeyValueServer", store, description=F.concat(F.lit("Key-value server "), store_port.cast("string")),
                config={"port": store_port}, parent_key=host,
            ),
        ),
        "database": (
            _basename("^ttcserver"),
            ResourceSpec(
                "DatabaseServer", F.concat_ws(":", who["name"], who["port"].cast("string")), who["name"], who["version"],
                F.concat(F.lit("Database server "), who["name"]), {"port": who["port"]}, host,
            ),
        ),
        "log indexer": (
            selected(PROCESS_QUERIES["log indexer"]),
            ResourceSpec(
                "LogIndexer", index_port, F.lit("LogIndexer"),
                config={"port": index_port, "home": F.try_element_at("env", F.lit("SPLUNK_HOME"))}, parent_key=host,
            ),
        ),
        "java": (
            _basename("^java") & F.coalesce(F.exists("argv", lambda a: a.startswith("org.apache.")), F.lit(False)),
            ResourceSpec(
                "JavaServer", main, main, A.version_of_arguments(argv, A.SERVER_JARS + A.COLLECTOR_JARS),
                F.concat(F.lit("Service "), main), {"command_line": A.java_main(argv)}, host,
            ),
        ),
    }


#: The kinds of servers found among processes.
SERVER_KINDS = ("workflow", "cache", "document", "key-value", "database", "log indexer", "java")


def server_resources(
    processes: DataFrame, kind: str | Sequence[str] = SERVER_KINDS, conf_files: DataFrame | None = None
) -> DataFrame:
    """Servers of one kind or several from process snapshots, in one scan.

    ``conf_files`` (host, path, body) gives the port of a key-value server whose
    file is named last among its arguments. A file that was not captured counts
    as one without a port line.
    """
    wanted = [kind] if isinstance(kind, str) else list(kind)
    if unknown := set(wanted) - set(SERVER_KINDS):
        raise ValueError(f"unknown server kind {', '.join(sorted(unknown))}")
    conf_port = F.lit(A.KEY_STORE_PORT)
    if conf_files is not None and "key-value" in wanted:
        kinds = _server_kinds(conf_port)
        stores = kinds["key-value"][0]
        # Of all processes only the servers are shuffled, of the files only their ports.
        servers = processes.filter(reduce(lambda a, b: a | b, [kinds[k][0] for k in wanted]))
        ports = conf_files.select(
            F.col("host").alias("_host"), F.col("path").alias("_path"), A.key_store_conf_port(F.col("body")).alias("_port")
        ).groupBy("_host", "_path").agg(F.min("_port").alias("_port"))
        named = F.when(stores, A.key_store_conf(F.col("argv"), F.col("cwd")))
        # A server without a file matches nothing: its own pid keeps such rows apart.
        place = F.coalesce(named, F.concat(F.lit("pid "), F.col("pid").cast("string")))
        servers = servers.withColumn("_place", place)
        processes = servers.join(ports, (servers["host"] == ports["_host"]) & (servers["_place"] == ports["_path"]), "left")
        conf_port = F.coalesce(F.col("_port"), conf_port)
    kinds = _server_kinds(conf_port)
    return build_inventories(processes, [kinds[k] for k in wanted])


def device_resources(devices: DataFrame) -> DataFrame:
    """Devices by address: ``name@address``, version from the description."""
    return build_inventory(
        devices,
        ResourceSpec(
            "Device", F.col("address"), F.concat_ws("@", "sys_name", "address"),
            A.version_of(F.col("sys_descr"), [A.DEVICE_VERSION]), F.col("sys_descr"), {"address": F.col("address")},
        ),
    )


def configured_resources(configs: DataFrame, resource_type: str, setting: str) -> DataFrame:
    """One resource per configured value; URLs lose their query, a directory must be absolute."""
    value = scrub_query(F.col(setting))
    rows = configs
    if resource_type == "Directory":
        rows = rows.filter(value.startswith("/"))
    return build_inventory(rows, ResourceSpec(resource_type, value, F.concat(F.lit(f"{resource_type} "), value), config={setting: value}))


# Fixed values inside: the prefixes of keys, names and descriptions.
def _configured_kinds(settings: Column, parent: Column) -> dict[str, tuple[Column, ResourceSpec]]:
    """By kind: which configurations are accepted, and how the resource is keyed by its settings."""

    def value(name: str, default: str | None = None) -> Column:
        found = F.try_element_at(settings, F.lit(name))
        return found if default is None else F.coalesce(found, F.lit(default))

    def named(resource_type: str, key: Column, prefix: str, description: Column | None = None) -> ResourceSpec:
        name = F.concat(F.lit(prefix), key)
        return ResourceSpec(resource_type, key, name, description=name if description is None else description, parent_key=parent)

    def prefixed(resource_type: str, at: Column, prefix: str, text: str) -> ResourceSpec:
        key = F.concat(F.lit(prefix), at)
        return ResourceSpec(resource_type, key, description=F.concat(F.lit(text), at), parent_key=parent)

    always = F.lit(True)
    address, port = value("address"), value("port")
    metastore = scrub_query(value("url"))
    return {
        "device": (
            always,
            ResourceSpec(
                "Device", address, F.concat(value("sys_name"), F.lit("@"), address),
                A.version_of(value("sys_descr"), [A.DEVICE_VERSION]), value("sys_descr"), {"address": address}, parent,
            ),
        ),
        "resolver": (always, named("Resolver", value("server"), "DNS server ")),
        "directory": (F.coalesce(value("directory").startswith("/"), F.lit(False)), named("Directory", value("directory"), "Directory ")),
        "path": (always, named("Path", value("url"), "PathInfo ")),
        "checked path": (always, named("CheckedPath", value("path", "/"), "NameNode FSCK ")),
        "metadata server": (always, prefixed("MetadataServer", metastore, "Hive Server ", "Hive Server connecting to ")),
        "trap port": (
            always, named("TrapReceiver", port, "SNMP recv ", F.concat(F.lit("SNMP trap and notification receiver on port "), port))
        ),
        "log indexer": (always, ResourceSpec("LogIndexer", port, F.lit("LogIndexer"), value("version"), config={"port": port}, parent_key=parent)),
        "status page": (
            always, prefixed("StatusPage", value("url"), "HbaseMasterInfo ", "Hbase master Info from HTML page at URL ")
        ),
        "queue page": (always, prefixed("QueuePage", value("url"), "Job Tracker Info ", "Job Tracker Info from HTML page at URL ")),
        "configuration client": (
            value("banner").isNotNull(),
            ResourceSpec("ConfigurationClient", F.lit("vd"), version=A.client_version(value("banner")), parent_key=parent),
        ),
        "broker": (always, named("Broker", port, "Broker ")),
    }


#: The kinds of resources that a configuration states.
CONFIGURED_KINDS = (
    "device", "resolver", "directory", "path", "checked path", "metadata server", "trap port", "log indexer",
    "status page", "queue page", "configuration client", "broker",
)


def stated_resources(configs: DataFrame, kinds: Sequence[str] = CONFIGURED_KINDS) -> DataFrame:
    """Resources of all kinds that rows (host, kind, settings) state, in one scan.

    A configuration without the setting its resource is keyed by, a directory
    that is not absolute and a client that answered nothing give no resource.
    """
    known = _configured_kinds(F.col("settings"), F.col("host"))
    if unknown := set(kinds) - set(known):
        raise ValueError(f"unknown configured kind {', '.join(sorted(unknown))}")
    return build_inventories(configs, [((F.col("kind") == k) & known[k][0], known[k][1]) for k in kinds])


# --- trees ------------------------------------------------------------------


def resource_paths(nodes: DataFrame, key: str = "key", parent: str = "parent_key", name: str = "name") -> DataFrame:
    """Rows (key, path, depth): names from the root down, joined by ``/``.

    Pointer doubling: each round joins every node with the node its path so far
    starts from, so a tree of depth d takes log2(d) rounds. Nodes that reach no
    root (a broken or circular parent) are left out. A round that brings no
    node to a root is the last: what is open then hangs on a circle.
    """
    state = nodes.select(
        F.col(key).alias("key"), F.col(parent).alias("_up"), F.col(name).alias("path"), F.lit(1).cast("bigint").alias("depth")
    )
    is_open = F.col("_up").isNotNull()
    # Finished nodes take part as targets only, so their missing pointers never meet in one task.
    finished, pending = state.filter(~is_open), state.filter(is_open)
    open_before = None
    while True:
        upper = finished.unionByName(pending).select(
            F.col("key").alias("_up"), F.col("_up").alias("_next"), F.col("path").alias("_path"), F.col("depth").alias("_depth")
        )
        moved = materialize(
            pending.join(upper, "_up").select(
                "key",
                F.col("_next").alias("_up"),
                F.concat_ws("/", "_path", "path").alias("path"),
                (F.col("depth") + F.col("_depth")).alias("depth"),
            ),
            "paths",
        )
        finished, pending = finished.unionByName(moved.filter(~is_open)), moved.filter(is_open)
        open_now = pending.count()
        if open_now in (0, open_before):
            return finished.drop("_up")
        open_before = open_now


def dependency_order(edges: DataFrame, items: DataFrame, item: str = "item", needs: str = "needs") -> DataFrame:
    """Rows (item, level): level 0 needs nothing, every other one is above all it needs.

    The links are written once. A round takes the items placed last, the
    frontier, and counts what they release: an item is placed in the round that
    meets its last need. Open counts are kept for items met so far only, so a
    round's rows are its frontier, the links to it and the items that wait half
    met. Items of a circle, and what needs them, get no level; a need that is no
    item itself counts as met.
    """
    known = materialize(items.select(F.col(item).alias("_item")).distinct(), "items")
    links = edges.select(F.col(item).alias("_item"), F.col(needs).alias("_needs")).distinct()
    links = materialize(links.join(known.select(F.col("_item").alias("_needs")), "_needs", "left_semi").select("_item", "_needs"), "links")
    degree = links.groupBy("_item").agg(F.count(F.lit(1)).alias("_open"))
    todo = materialize(known.join(degree, "_item"), "degrees")
    frontier = materialize(known.join(degree, "_item", "left_anti"), "frontier")
    placed, level, half = [], 0, None
    while True:
        placed.append(frontier.withColumn("level", F.lit(level)))
        met = links.join(frontier.select(F.col("_item").alias("_needs")), "_needs").groupBy("_item").agg(F.count(F.lit(1)).alias("_met"))
        if half is not None:
            met = met.unionByName(half).groupBy("_item").agg(F.sum("_met").alias("_met"))
        counted = materialize(
            met.join(todo, "_item").select("_item", "_met", (F.col("_met") == F.col("_open")).alias("_done")), "levels"
        )
        frontier = counted.filter("_done").select("_item")
        half = counted.filter(~F.col("_done")).select("_item", "_met")
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, placed).select(F.col("_item").alias(item), "level")
        level += 1
