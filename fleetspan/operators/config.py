"""Configuration snapshots: flattening, overlay, change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.operators.availability import enabled
from fleetspan.operators.joins import null_safe_join
from fleetspan.operators.report import last_wins
from fleetspan.operators.skew import DEFAULT_POLICY, HotKeyPolicy, with_previous

# Setting names with a meaning of their own.
ARGS, ENV, ENABLED, SERVICE, MONITOR = "args", "env", "enabled", "service", "monitor"


def config_settings(df: DataFrame, body: str, root: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (keep..., host, scope, service, key, values) of configuration documents.

    A document is host -> root -> monitor -> settings, ``env`` and ``service``;
    scope is ``host`` or ``service``, with ``.env`` for environment entries.
    """
    hosts = F.explode(F.from_json(F.col(body), "MAP<STRING, STRING>")).alias("host", "_tree")
    monitors = df.select(*keep, hosts).select(
        *keep, "host",
        F.from_json(F.get_json_object("_tree", f"$['{root}'].{MONITOR}"), "MAP<STRING, STRING>").alias("_m"),
    )
    host_level = F.array(F.struct(F.lit("host").alias("scope"), F.lit(None).cast("string").alias("service"), F.col("_m").alias("node")))
    services = F.transform(
        F.map_entries(F.from_json(F.col("_m")[SERVICE], "MAP<STRING, STRING>")),
        lambda e: F.struct(
            F.lit("service").alias("scope"), e["key"].alias("service"),
            F.from_json(e["value"], "MAP<STRING, STRING>").alias("node"),
        ),
    )
    empty = F.array().cast("array<struct<scope: string, service: string, node: map<string, string>>>")
    nodes = monitors.select(*keep, "host", F.explode(F.concat(host_level, F.coalesce(services, empty))).alias("_n"))
    plain = F.transform(
        F.map_entries(F.map_filter(F.col("_n.node"), lambda k, _: ~k.isin(ENV, SERVICE))),
        lambda e: F.struct(F.lit("").alias("part"), e["key"].alias("key"), F.from_json(e["value"], "ARRAY<STRING>").alias("values")),
    )
    env = F.transform(
        F.map_entries(F.from_json(F.col("_n.node")[ENV], "MAP<STRING, STRING>")),
        lambda e: F.struct(F.lit(".env").alias("part"), e["key"].alias("key"), F.from_json(e["value"], "ARRAY<STRING>").alias("values")),
    )
    none = F.array().cast("array<struct<part: string, key: string, values: array<string>>>")
    return (
        nodes.select(
            *keep, "host", "_n.scope", "_n.service",
            F.explode(F.concat(F.coalesce(plain, none), F.coalesce(env, none))).alias("_s"),
        )
        .filter(F.col("_s.values").isNotNull())
        .select(*keep, "host", F.concat("scope", "_s.part").alias("scope"), "service", F.col("_s.key").alias("key"), F.col("_s.values").alias("values"))
    )


def flat_value(values: Column) -> Column:
    """A list-valued setting as one text; nothing goes between the items."""
    return F.array_join(values, "")


def overlay(base: DataFrame, override: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Settings of both sides; where both have a key the override's value counts, unless it is null."""
    sides = [
        side.select(*keys, F.col(value).alias("_v"), F.lit(rank).alias("_rank"))
        for rank, side in enumerate((base, override))
    ]
    merged = sides[0].unionByName(sides[1])
    return merged.groupBy(*keys).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_rank"))).alias(value))


def service_settings(df: DataFrame, body: str, root: str, keep: Sequence[str] = ()) -> DataFrame:
    """Per (keep..., host, service): MAP of its settings over the host's, env merged, ``enabled`` defaulted, and its args.

    Host and services are in one document, so the overlay is made inside the
    row: no join and no shuffle. Environment entries are keyed ``env.NAME``.
    """
    def node(text: Column) -> Column:
        return F.from_json(text, "MAP<STRING, STRING>")

    def lists(settings: Column) -> Column:
        parsed = F.transform_values(settings, lambda _, v: F.from_json(v, "ARRAY<STRING>"))
        return F.transform_values(F.map_filter(parsed, lambda _, v: v.isNotNull()), lambda _, v: flat_value(v))

    def own_settings(settings: Column) -> Column:
        plain = lists(F.map_filter(settings, lambda k, _: ~k.isin(ARGS, ENV, SERVICE)))
        env = F.transform_keys(lists(node(settings[ENV])), lambda k, _: F.concat(F.lit("env."), k))
        return F.map_concat(plain, F.coalesce(env, F.create_map().cast("map<string, string>")))

    hosts = df.select(*keep, F.explode(node(F.col(body))).alias("host", "_tree"))
    monitors = hosts.select(*keep, "host", node(F.get_json_object("_tree", f"$['{root}'].{MONITOR}")).alias("_m"))
    services = monitors.select(
        *keep, "host", own_settings(F.col("_m")).alias("_base"), F.explode(node(F.col("_m")[SERVICE])).alias("service", "_text")
    ).withColumn("_own", node(F.col("_text")))
    layered = services.select(
        *keep, "host", "service", "_base", own_settings(F.col("_own")).alias("_set"),
        F.coalesce(F.from_json(F.col("_own")[ARGS], "ARRAY<STRING>"), F.array().cast("array<string>")).alias("args"),
    )
    merged = F.map_concat(
        F.map_filter("_base", lambda k, _: ~F.map_contains_key("_set", k)),
        F.col("_set"),
        F.when(
            F.map_contains_key("_set", ENABLED) | F.map_contains_key("_base", ENABLED), F.create_map().cast("map<string, string>")
        ).otherwise(F.create_map(F.lit(ENABLED), F.lit("true"))),
    )
    return layered.select(*keep, "host", "service", merged.alias("settings"), "args")


def enabled_services(services: DataFrame) -> DataFrame:
    return services.filter(enabled(F.col("settings")[ENABLED]))


def watched_services(known: DataFrame, services: DataFrame) -> DataFrame:
    """Known services with the ``enabled`` trait; a removed one reports false and stays up."""
    now = services.select("host", "service", F.col("settings")[ENABLED].alias("_enabled"))
    return (
        known.join(now, ["host", "service"], "left")
        .withColumns({"enabled": F.coalesce("_enabled", F.lit("false")), "up": F.lit(True)})
        .drop("_enabled")
    )


def config_changes(
    snapshots: DataFrame, keys: Sequence[str], order: Sequence[str], content: Column, policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add ``changed``: the content's hash differs from the one before; the first snapshot is no change."""
    hashed = snapshots.withColumn("content_hash", F.sha2(content.cast("string").cast("binary"), 256))
    rows = with_previous(hashed, keys, order, {"_before": ("content_hash", None)}, policy)
    return rows.withColumn(
        "changed", F.col("_before").isNotNull() & ~F.col("content_hash").eqNullSafe(F.col("_before"))
    ).drop("_before")


# --- refreshed documents and the inventory that follows them ------------------


def service_hashes(body: Column, root: str) -> Column:
    """MAP of the services of a document to a hash of their settings, the host's own included.

    A change of the host's settings is a change of all its services. A document
    without the host, the root or services, or a broken one, has none.
    """
    def node(text: Column) -> Column:
        return F.from_json(text, "MAP<STRING, STRING>")

    tree = F.get(F.map_values(node(body)), F.lit(0))
    monitor = node(F.get_json_object(tree, f"$['{root}'].{MONITOR}"))
    services = F.coalesce(node(monitor[SERVICE]), F.create_map().cast("map<string, string>"))
    base = F.to_json(F.array_sort(F.map_entries(F.map_filter(monitor, lambda k, _: k != SERVICE))))
    # One-element lists bind what is computed once for all services.
    bound = F.transform(F.array(base), lambda b: F.transform_values(services, lambda _, v: F.sha2(F.concat_ws("\n", b, v).cast("binary"), 256)))
    return bound[0]


#: State of refreshed configurations: a row per child, and one without a child for the document as a whole.
CHILD_STATE = "child STRING, hash STRING, removed BOOLEAN"


def refreshed_children(
    refreshes: DataFrame,
    host: str,
    order: Sequence[str],
    content: Column,
    children: Column,
    state: DataFrame | None = None,
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """What every refresh of a host's configuration changed.

    ``content`` is the document (null: the refresh failed, so all stays as it
    is), ``children`` the MAP of its children to a hash of their settings. Added
    are ``changed`` (the document differs from the one before; the first is no
    change), ``changes``, an ARRAY of (child, status, hash) with status ``added``,
    ``removed`` or ``changed``, and ``content_hash``. ``state`` is what was known
    before, see ``children_state``. Null is a host like any other.
    """
    columns = [c for c in refreshes.columns if c != host]
    rows = refreshes.withColumns({
        "_hash": F.sha2(content.cast("string").cast("binary"), 256),
        "_now": F.coalesce(children, F.create_map().cast("map<string, string>")),
        "_there": F.lit(True),
    })
    good = rows.filter(F.col("_hash").isNotNull())
    seen = with_previous(good, [host], order, {"_had": ("_there", None), "_before": ("_hash", None), "_old": ("_now", None)}, policy)
    if state is not None:
        live = F.when(F.col("child").isNotNull() & ~F.col("removed"), F.struct("child", "hash"))
        # All children of a host, as many as its documents named.
        known = state.groupBy(host).agg(
            F.max(F.when(F.col("child").isNull(), F.col("hash"))).alias("_last"), F.map_from_entries(F.collect_list(live)).alias("_live")
        )
        seen = null_safe_join(seen, known, [host], "left")
        seen = seen.withColumn("_before", F.when(F.col("_had"), F.col("_before")).otherwise(F.col("_last")))
        seen = seen.withColumn("_old", F.when(F.col("_had"), F.col("_old")).otherwise(F.col("_live"))).drop("_last", "_live")
    none = F.create_map().cast("map<string, string>")
    seen = seen.withColumn("_old", F.coalesce("_old", none))

    def change(entries: Column, status: str, gone: bool = False) -> Column:
        return F.transform(entries, lambda e: F.struct(
            e["key"].alias("child"), F.lit(status).alias("status"), (F.lit(None).cast("string") if gone else e["value"]).alias("hash")
        ))

    now, old = F.map_entries("_now"), F.map_entries("_old")
    added = F.filter(now, lambda e: ~F.map_contains_key("_old", e["key"]))
    altered = F.filter(now, lambda e: F.map_contains_key("_old", e["key"]) & (F.try_element_at("_old", e["key"]) != e["value"]))
    removed = F.filter(old, lambda e: ~F.map_contains_key("_now", e["key"]))
    changes = F.concat(change(added, "added"), change(altered, "changed"), change(removed, "removed", True))
    told = seen.select(
        host, *columns, (F.col("_before").isNotNull() & (F.col("_hash") != F.col("_before"))).alias("changed"), changes.alias("changes"),
        F.col("_hash").alias("content_hash"),
    )
    failed = rows.filter(F.col("_hash").isNull()).select(
        host, *columns, F.lit(False).alias("changed"),
        F.array().cast("array<struct<child: string, status: string, hash: string>>").alias("changes"), F.col("_hash").alias("content_hash"),
    )
    return told.unionByName(failed)


def children_state(told: DataFrame, host: str, order: Sequence[str]) -> DataFrame:
    """Rows of the state (host, child, hash, removed) that refreshes touched, from what ``refreshed_children`` told.

    A removed child stays as a tombstone; the row without a child has the hash of the whole document.
    """
    events = told.select(host, *order, F.explode("changes").alias("_c")).select(
        host, *order, F.col("_c.child").alias("child"), F.struct("_c.hash", (F.col("_c.status") == "removed").alias("removed")).alias("_v")
    )
    # Structs, as a null value must win over an older one.
    newest = last_wins(events, [host, "child"], order, ["_v"])
    documents = told.filter(F.col("content_hash").isNotNull()).groupBy(host).agg(F.max_by("content_hash", F.struct(*order)).alias("hash"))
    return newest.select(host, "child", "_v.hash", "_v.removed").unionByName(
        documents.select(host, F.lit(None).cast("string").alias("child"), "hash", F.lit(False).alias("removed"))
    )
