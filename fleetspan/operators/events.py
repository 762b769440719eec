"""Events: severity rules, traps to text, state changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.coerce import INTEGER_TYPES
from fleetspan.functions.extract import output_text
from fleetspan.functions.oid import drop_instance, starts_with_oid, ticks_text
from fleetspan.functions.text import scrub
from fleetspan.operators.skew import DEFAULT_POLICY, HotKeyPolicy, with_previous
from fleetspan.operators.snmp import Constants, codes_table, constants, decode_codes, oid_names

DEFAULT_SEVERITY = "INFO"


@dataclass(frozen=True)
class Rule:
    """A severity rule; an unset condition is ignored, all set ones must hold."""

    severity: str
    generic: int | None = None
    specific: int | None = None
    enterprise: str = ""
    trap_oid: str = ""
    varbind: str = ""
    value: str = ""


def template_rules() -> list[Rule]:
    """Rules for the generic trap types."""
    # Severity by generic trap type 0 to 6.
    severities = ["WARN", "WARN", "ERROR", "INFO", "WARN", "ERROR", "WARN"]
    return [Rule(severity, generic=number) for number, severity in enumerate(severities)]


def rule_matches(rule: Rule, compat: bool = False) -> Column:
    """Whether a trap meets a rule; ``compat`` turns the v2 identifier test round."""
    v1 = F.lit(True)
    if rule.generic is not None:
        v1 &= F.col("generic") == rule.generic
    if rule.specific is not None:
        v1 &= F.col("specific") == rule.specific
    if rule.enterprise:
        v1 &= starts_with_oid(F.col("enterprise"), rule.enterprise)
    v2 = F.lit(True)
    if compat:
        v2 = F.col("trap_oid").isNull() | ~starts_with_oid(F.col("trap_oid"), rule.trap_oid)
    elif rule.trap_oid:
        v2 = starts_with_oid(F.col("trap_oid"), rule.trap_oid)
    matched = F.when(F.col("version") == 1, v1).otherwise(v2)
    if rule.varbind:
        bound = F.filter("varbinds", lambda v: drop_instance(v["oid"]) == drop_instance(F.lit(rule.varbind)))
        matched &= F.try_element_at(bound, F.lit(1))["value"].rlike(rule.value)
    return F.coalesce(matched, F.lit(False))


def rules_from(df: DataFrame) -> list[Rule]:
    """Rules of a configuration table, in their order."""
    return [
        Rule(
            r["severity"], r["generic"], r["specific"], r["enterprise"] or "", r["trap_oid"] or "",
            r["varbind"] or "", r["value"] or "",
        )
        for r in df.orderBy("rule_order").toLocalIterator()
    ]


def first_match(conditions: Sequence[tuple[Column, str]], default: str | None = DEFAULT_SEVERITY, per_case: int = 50) -> Column:
    """Result of the first condition that holds.

    A chain of conditions instead of a join on a predicate: rows are never
    paired with rules. Long lists are split so that generated code stays small.
    """
    parts = []
    for start in range(0, len(conditions), per_case):
        case = None
        for condition, result in conditions[start : start + per_case]:
            case = F.when(condition, result) if case is None else case.when(condition, result)
        parts.append(case)
    return F.coalesce(*parts, F.lit(default)) if parts else F.lit(default)


def classify(traps: DataFrame, rules: Sequence[Rule], default: str = DEFAULT_SEVERITY, compat: bool = False) -> DataFrame:
    """Add ``severity`` by the first rule that matches."""
    return traps.withColumn("severity", first_match([(rule_matches(r, compat), r.severity) for r in rules], default))


# Fixed value: source of a trap whose sender has no internet address.
LOCAL_SOURCE = "snmp-agent"


def trap_source(source_oid: str | None = None) -> Column:
    """The source variable's value, else the sender's host name, address or ``unknown``."""
    peer = F.when(
        F.coalesce(F.col("peer_is_ip"), F.lit(True)),
        F.coalesce("peer_host", "peer_address", F.lit("unknown")),
    ).otherwise(F.lit(LOCAL_SOURCE))
    if not source_oid:
        return peer
    stated = F.filter("varbinds", lambda v: drop_instance(v["oid"]) == drop_instance(F.lit(source_oid)))
    return F.coalesce(F.try_element_at(stated, F.lit(-1))["value"], peer)


def ordered_text(pairs: Column) -> Column:
    """``name: value`` lines of ARRAY<STRUCT(pos, name, value)> in position order."""
    in_order = F.array_sort(pairs)
    return F.array_join(
        F.transform(
            in_order, lambda p: F.concat(p["name"], F.lit(": "), F.coalesce(p["value"], F.lit("null")), F.lit("\n"))
        ),
        "",
    )


def decode_traps(
    traps: DataFrame,
    mib: DataFrame,
    rules: Sequence[Rule] = (),
    omitted: Sequence[str] = (),
    pattern: str = "",
    source_oid: str | None = None,
    default: str = DEFAULT_SEVERITY,
    compat: bool = False,
) -> DataFrame:
    """Events (trap_id, type, source, ts, severity, detail) of captured traps.

    With a small dictionary (``snmp.constants``) variables are named and decoded
    inside the trap's row. With a larger one they are taken apart, named and
    decoded by joins, and put together again per trap: a trap's variables are
    bounded by its packet, so that last grouping has no large group. A trap is
    known by its id and its content: one delivered several times gives one
    event, and traps without an id stay apart.
    """
    content = F.xxhash64(*[F.col(c) for c in traps.columns])
    head = classify(traps.withColumn("_trap", content), rules, default, compat).withColumn("source", trap_source(source_oid))
    v1_header = F.when(
        F.col("version") == 1,
        F.concat(
            F.lit("Traptype (generic, specific): "), F.col("generic").cast("string"), F.lit(", "),
            F.col("specific").cast("string"), F.lit("\nTimestamp: "), ticks_text(F.coalesce("uptime_ticks", F.lit(0))),
            F.lit("\nEnterprise: "),
        ),
    )
    if small := constants(mib):
        return _decode_in_row(head, v1_header, small, omitted, pattern)
    # The first part of every trap carries what belongs to the trap as a whole, with the enterprise to be named.
    no_text = F.lit(None).cast("string")
    whole = F.struct("source", "ts", "severity", v1_header.alias("header"))
    first = F.struct(F.col("enterprise").alias("oid"), no_text.alias("type"), no_text.alias("value"), whole.alias("whole"))
    rest = F.transform(
        F.coalesce("varbinds", F.array().cast("array<struct<oid: string, type: string, value: string>>")),
        lambda v: F.struct(
            drop_instance(v["oid"]).alias("oid"), v["type"].alias("type"), v["value"].alias("value"),
            F.when(F.lit(False), whole).alias("whole"),
        ),
    )
    parts = head.select("trap_id", "_trap", F.posexplode(F.concat(F.array(first), rest)).alias("pos", "_v")).select(
        "trap_id", "_trap", "pos", "_v.*"
    )
    if omitted:
        parts = parts.filter((F.col("pos") == 0) | ~F.col("oid").isin(*[o.removesuffix(".0") for o in omitted]))
    named = oid_names(parts, mib)
    identifiers = oid_names(
        named.withColumn("_as_oid", F.when(F.col("type") == "OID", F.col("value"))), mib, "_as_oid", "_value_name"
    )
    coded = identifiers.withColumns(
        {
            "_code": F.when(F.col("type").isin(*INTEGER_TYPES), F.col("value").try_cast("int")),
            "_base": F.regexp_extract("oid_name", r"^([^.]*)", 1),
        }
    )
    labels = codes_table(mib).withColumnsRenamed({"name": "_base", "code": "_code", "label": "_label"})
    texts = coded.join(labels, ["_base", "_code"], "left").withColumn(
        "_text", F.coalesce("_label", "_value_name", F.col("value"))
    )
    # One grouping puts the traps together again: the only shuffle of the job.
    line = F.struct("pos", F.col("oid_name").alias("name"), F.col("_text").alias("value"))
    grouped = texts.groupBy("trap_id", "_trap").agg(
        F.max(F.when(F.col("pos") == 0, F.struct("whole.*", F.col("oid_name").alias("enterprise")))).alias("_w"),
        F.collect_set(F.when(F.col("pos") > 0, line)).alias("_lines"),
    )
    header = F.coalesce(
        F.concat("_w.header", F.coalesce("_w.enterprise", F.lit("")), F.lit("\n")), F.lit("")
    )
    return grouped.select(
        "trap_id", F.lit("Trap").alias("type"), F.col("_w.source").alias("source"), F.col("_w.ts").alias("ts"),
        F.col("_w.severity").alias("severity"), scrub(F.concat(header, ordered_text(F.col("_lines"))), pattern).alias("detail"),
    )


def _decode_in_row(head: DataFrame, v1_header: Column, known: Constants, omitted: Sequence[str], pattern: str) -> DataFrame:
    """Events of traps whose identifiers are all looked up in constants; the only shuffle finds repeated traps."""
    plain = [o.removesuffix(".0") for o in omitted]
    # Positions are those in the trap, so that what is left out does not move the rest.
    variables = F.transform(
        "varbinds", lambda v, i: F.struct(i.alias("pos"), drop_instance(v["oid"]).alias("oid"), v["type"].alias("type"), v["value"].alias("value"))
    )
    if plain:
        variables = F.filter(variables, lambda v: ~v["oid"].isin(*plain))
    variables = F.transform(variables, lambda v: F.struct(v["pos"].alias("pos"), known.name(v["oid"]).alias("name"), v["type"].alias("type"), v["value"].alias("value")))

    def line(v: Column) -> Column:
        code = F.when(v["type"].isin(*INTEGER_TYPES), v["value"].try_cast("int"))
        label = known.label(F.regexp_extract(v["name"], r"^([^.]*)", 1), code)
        text = F.coalesce(label, F.when(v["type"] == "OID", known.name(v["value"])), v["value"])
        return F.struct(v["pos"].alias("pos"), v["name"].alias("name"), text.alias("value"))

    header = F.coalesce(F.concat(v1_header, F.coalesce(known.name(F.col("enterprise")), F.lit("")), F.lit("\n")), F.lit(""))
    body = F.coalesce(ordered_text(F.transform(variables, line)), F.lit(""))
    return (
        head.select("trap_id", "_trap", F.lit("Trap").alias("type"), "source", "ts", "severity", scrub(F.concat(header, body), pattern).alias("detail"))
        .distinct()
        .drop("_trap")
    )


# Severity of an exit code; other codes raise no event.
EXIT_SEVERITY = {0: "INFO", 1: "WARN", 2: "ERROR"}


def exit_severity(code: Column) -> Column:
    return F.create_map(*[x for c, s in EXIT_SEVERITY.items() for x in (F.lit(c), F.lit(s))])[code]


def state_changes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, initial: Column, policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows whose state differs from the one before; ``previous`` holds that one."""
    rows = with_previous(df, keys, order, {"previous": (state, initial)}, policy)
    return rows.filter(~F.col(state).eqNullSafe(F.col("previous")))


def exit_events(
    runs: DataFrame, keys: Sequence[str], order: Sequence[str], code: str, output: Column | None = None,
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One event per change of a check's exit code, the first compared with 0.

    Codes other than 0, 1 and 2 raise no event and leave the state as it is.
    """
    valid = runs.filter(F.col(code).isin(*EXIT_SEVERITY))
    changes = state_changes(valid, keys, order, code, F.lit(0).cast(runs.schema[code].dataType), policy)
    text = F.concat(F.lit("exit code "), F.col(code).cast("string"))
    detail = text if output is None else F.when(F.coalesce(F.length(output), F.lit(0)) == 0, text).otherwise(output_text(output))
    return changes.withColumns({"severity": exit_severity(F.col(code)), "detail": detail})
