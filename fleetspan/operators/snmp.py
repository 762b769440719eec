"""Readings by object identifier: dictionary joins and table assembly."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.coerce import compose64
from fleetspan.functions.oid import drop_instance, index_name, oid_array
from fleetspan.operators.skew import estimated_bytes
from fleetspan.session import local_table

# Identifiers that report an error instead of data.
ERROR_OIDS = {
    "1.3.6.1.6.3.15.1.1.1": "usmStatsUnsupportedSecLevels",
    "1.3.6.1.6.3.15.1.1.2": "usmStatsNotInTimeWindows",
    "1.3.6.1.6.3.15.1.1.3": "usmStatsUnknownUserNames",
    "1.3.6.1.6.3.15.1.1.4": "usmStatsUnknownEngineIDs",
    "1.3.6.1.6.3.15.1.1.5": "usmStatsWrongDigests",
    "1.3.6.1.6.3.15.1.1.6": "usmStatsDecryptionErrors",
    "1.3.6.1.6.3.11.2.1.1": "snmpUnknownSecurityModels",
    "1.3.6.1.6.3.11.2.1.2": "snmpInvalidMsgs",
    "1.3.6.1.6.3.11.2.1.3": "snmpUnknownPDUHandlers",
}


#: A dictionary is looked up length by length up to this many lengths and entries.
MAX_LOOKUPS = 32
MAX_ENTRIES = 100_000


def longest_prefix(
    probe: DataFrame, column: str, dictionary: DataFrame, key: str, payload: Sequence[str], separator: str = "."
) -> DataFrame:
    """Add the payload of the dictionary entry with the longest matching prefix, and the prefix itself.

    A prefix ends at a separator or at the end, so only prefixes with as many
    steps as some key can match. A small dictionary, as that of a MIB, is read
    once, its size checked, and looked up once per number of steps: the probe is
    not shuffled. For a larger one the distinct probe values are spread into
    their prefixes, joined by equality, and the longest hit is joined back.
    Probes without an entry keep nulls; of equal keys the largest payload counts.
    """
    known = dictionary.select(F.col(key).alias("_key"), *payload).filter(F.col("_key").isNotNull())
    limit = _bytes(probe.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if estimated_bytes(known) <= limit:
        entries = known.limit(MAX_ENTRIES + 1).collect()
        if len(entries) <= MAX_ENTRIES and len({_steps(e[0], separator) for e in entries}) <= MAX_LOOKUPS:
            return _lookup_by_length(probe, column, known, entries, payload, separator)
    return _lookup_by_prefix(probe, column, known, payload, separator)


def _steps(key: str, separator: str) -> int:
    return key.count(separator) + 1


def _bytes(size: str) -> int:
    """Bytes of a size setting such as ``10MB``; a negative one is 0."""
    digits = re.match(r"-?\d+", size)
    unit = size[digits.end() :].strip().lower()[:1]
    return max(0, int(digits.group()) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30}[unit])


def _lookup_by_length(
    probe: DataFrame, column: str, known: DataFrame, entries: list, payload: Sequence[str], separator: str
) -> DataFrame:
    # Nulls order first, as in Spark.
    ordered = sorted((tuple(e) for e in entries), key=lambda e: tuple((v is not None, v) for v in e))
    by_length: dict[int, dict[str, tuple]] = {}
    for entry in ordered:
        by_length.setdefault(_steps(entry[0], separator), {})[entry[0]] = entry
    rows, hits = probe, []
    for n in sorted(by_length, reverse=True):
        found = local_table(probe.sparkSession, list(by_length[n].values()), known.schema)
        hit = found.select(F.col("_key").alias(f"_key{n}"), F.struct("_key", *payload).alias(f"_hit{n}"))
        rows = rows.join(hit, F.substring_index(F.col(column), separator, n) == F.col(f"_key{n}"), "left").drop(f"_key{n}")
        hits.append(F.col(f"_hit{n}"))
    if not hits:
        empty = {p: F.lit(None).cast(known.schema[p].dataType) for p in payload}
        return probe.withColumns({"prefix": F.lit(None).cast("string"), **empty})
    best = F.coalesce(*hits)
    return rows.withColumns({"prefix": best["_key"], **{p: best[p] for p in payload}}).drop(*[f"_hit{n}" for n in by_length])


def _lookup_by_prefix(
    probe: DataFrame, column: str, known: DataFrame, payload: Sequence[str], separator: str
) -> DataFrame:
    literal = re.escape(separator)
    steps = [r[0] for r in known.select(F.size(F.split("_key", literal))).distinct().limit(MAX_LOOKUPS + 1).collect()]
    parts = F.split(F.col(column), literal)
    # With too many different lengths every prefix of the probe is tried.
    tried = F.sequence(F.lit(1), F.size(parts)) if len(steps) > MAX_LOOKUPS else F.array(*[F.lit(n) for n in steps]).cast("array<int>")
    prefixes = F.transform(
        F.filter(tried, lambda n: n <= F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator)
    )
    values = probe.select(column).filter(F.col(column).isNotNull()).distinct()
    best = (
        values.select(column, F.explode(prefixes).alias("_key"))
        .join(known, "_key")
        .groupBy(column)
        .agg(F.max(F.struct(F.length("_key").alias("_n"), "_key", *payload)).alias("_best"))
    )
    resolved = best.select(column, F.col("_best._key").alias("prefix"), *[F.col("_best")[p].alias(p) for p in payload])
    return probe.join(resolved, column, "left")


def oid_names(readings: DataFrame, mib: DataFrame, oid: str = "oid", out: str = "oid_name") -> DataFrame:
    """Add the name of each identifier: dictionary name plus suffix, the text itself when unknown."""
    dictionary = mib.select(F.col("oid").alias("_oid"), F.col("name").alias("_name"))
    named = longest_prefix(readings, oid, dictionary, "_oid", ["_name"])
    suffix = F.substring(F.col(oid), F.length("prefix") + 1, F.length(oid))
    return named.withColumn(out, F.coalesce(F.concat("_name", suffix), F.col(oid))).drop("prefix", "_name")


#: Entries, and codes, of a dictionary that is held as constants of the plan.
MAX_CONSTANTS = 256


@dataclass(frozen=True)
class Constants:
    """A small dictionary as maps in the plan: identifiers are named inside their row, inside arrays too, without a join."""

    names: dict[int, dict[str, str]]
    codes: dict[str, str]

    def name(self, oid: Column) -> Column:
        """The same name as that of ``oid_names``."""
        found = []
        for n in sorted(self.names, reverse=True):
            prefix = F.substring_index(oid, ".", n)
            name = F.try_element_at(constant_map(self.names[n]), prefix)
            found.append(F.concat(name, F.substring(oid, F.length(prefix) + 1, F.length(oid))))
        return F.coalesce(*found, oid)

    def label(self, name: Column, code: Column) -> Column:
        """The label of an integer code of a name, null if there is none."""
        if not self.codes:
            return F.lit(None).cast("string")
        return F.try_element_at(constant_map(self.codes), F.concat(name, F.lit(" "), code.cast("string")))


def constant_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def constants(mib: DataFrame) -> Constants | None:
    """The dictionary as constants, if it is known to be small, and its entries have names and no two labels for a code."""
    known = mib.select("oid", "name", "codes").filter(F.col("oid").isNotNull())
    if estimated_bytes(known) > _bytes(mib.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")):
        return None
    entries = known.limit(MAX_CONSTANTS + 1).collect()
    pairs = [(f"{e.name} {code}", label) for e in entries for code, label in (e.codes or {}).items()]
    if max(len(entries), len(pairs)) > MAX_CONSTANTS or any(e.name is None for e in entries):
        return None
    codes = dict(pairs)
    if len(codes) < len(pairs) or None in codes.values():
        return None
    names: dict[int, dict[str, str]] = {}
    for e in sorted(entries, key=lambda e: e.name):  # of equal identifiers the largest name counts
        names.setdefault(_steps(e.oid, "."), {})[e.oid] = e.name
    return Constants(names, codes)


def name_oids(names: DataFrame, mib: DataFrame, column: str = "oid_name", out: str = "oid") -> DataFrame:
    """Add the identifier of ``name[.suffix]``; text that starts with a digit is one already."""
    pattern = r"^([^.]+)((?:\.\d+)*)$"
    keyed = names.withColumn("_name", F.regexp_extract(F.col(column), pattern, 1))
    known = mib.select(F.col("name").alias("_name"), F.col("oid").alias("_oid"))
    return (
        keyed.join(known, "_name", "left")
        .withColumn(
            out,
            F.coalesce(
                F.concat("_oid", F.regexp_extract(F.col(column), pattern, 2)),
                F.when(F.col(column).rlike(r"^\d+(\.\d+)*$"), F.col(column)),
            ),
        )
        .drop("_name", "_oid")
    )


def decode_codes(df: DataFrame, dictionary: DataFrame, name: str, code: str, out: str = "label") -> DataFrame:
    """Add the label of an integer code; an unknown code keeps its number."""
    known = dictionary.select(F.col("name").alias(name), F.col("code").alias(code), F.col("label").alias("_label"))
    return (
        df.join(known, [name, code], "left")
        .withColumn(out, F.coalesce("_label", F.col(code).cast("string")))
        .drop("_label")
    )


def codes_table(mib: DataFrame) -> DataFrame:
    """Rows (name, code, label) of a dictionary's code maps."""
    return mib.select("name", F.explode("codes").alias("code", "label"))


def drop_exceptions(readings: DataFrame) -> DataFrame:
    return readings.filter(~F.coalesce(F.col("is_exception"), F.lit(False)))


def omit(readings: DataFrame, omitted: DataFrame, oid: str = "oid") -> DataFrame:
    """Readings whose identifier, without a scalar's ``.0``, is not in the list."""
    keyed = readings.withColumn("_plain", drop_instance(F.col(oid)))
    drop = omitted.select(drop_instance(F.col("oid")).alias("_plain")).distinct()
    return keyed.join(drop, "_plain", "left_anti").drop("_plain")


def error_reports(readings: DataFrame, report_id: Sequence[str]) -> DataFrame:
    """Reports that hold a single reading of a known error identifier, with the error's name."""
    errors = readings.sparkSession.createDataFrame(
        [(oid, name) for oid, name in ERROR_OIDS.items()], "_plain STRING, error STRING"
    )
    single = readings.groupBy(*report_id).agg(F.count(F.lit(1)).alias("_n"), F.min("oid").alias("oid"))
    return (
        single.filter(F.col("_n") == 1)
        .withColumn("_plain", drop_instance(F.col("oid")))
        .join(F.broadcast(errors), "_plain")
        .select(*report_id, "oid", "error")
    )


def table_cells(readings: DataFrame, columns: DataFrame) -> DataFrame:
    """Readings of table columns with ``column`` name and ``row_index`` suffix.

    ``columns`` has (oid, name) of the table's columns; others are left out.
    """
    dictionary = columns.select(F.col("oid").alias("_oid"), F.col("name").alias("column"))
    found = longest_prefix(drop_exceptions(readings), "oid", dictionary, "_oid", ["column"])
    return (
        found.filter(F.col("prefix").isNotNull())
        .withColumn("row_index", F.substring(F.col("oid"), F.length("prefix") + 2, F.length("oid")))
        .filter(F.col("row_index") != "")
        .drop("prefix")
    )


def assemble_rows(
    cells: DataFrame, keys: Sequence[str], columns: Sequence[str], value: str = "value", position: Sequence[str] = ()
) -> DataFrame:
    """One row per key with a column per name: the pivot of a fixed column list, last value first."""
    def pick(name: str) -> Column:
        hit = F.col("column") == name
        if not position:
            return F.max(F.when(hit, F.col(value)))
        return F.max_by(F.col(value), F.when(hit, F.struct(*position)))

    return cells.groupBy(*keys).agg(*[pick(c).alias(c) for c in columns])


def composed_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add a 64-bit column for each ``low^high`` name, null where a half is missing or not unsigned."""
    out = rows
    for name in names:
        low, high = name.split("^")
        out = out.withColumn(name, compose64(F.col(low).try_cast("bigint"), F.col(high).try_cast("bigint")))
    return out


def correlated(left: DataFrame, right: DataFrame, agent: str, left_index: str, right_index: str) -> DataFrame:
    """Rows of two tables of one agent that share a device index."""
    keyed = right.withColumnRenamed(right_index, left_index)
    return left.join(keyed, [agent, left_index])


def row_resources(cells: DataFrame, table: str, index_columns: list[tuple[str, str]], agent: str = "agent") -> DataFrame:
    """Inventory of a table's rows: key is the row index, the name spells out its decoded columns."""
    name = index_name(oid_array(F.col("row_index")), index_columns)
    return (
        cells.select(agent, "row_index").distinct()
        .select(
            F.lit(table).alias("type"),
            F.col("row_index").alias("key"),
            name.alias("name"),
            F.lit(None).cast("string").alias("version"),
            F.concat(F.lit(f"SNMP table {table}, row index "), name).alias("description"),
            F.create_map(F.lit("index"), F.col("row_index"), F.lit("table"), F.lit(table)).alias("config"),
            F.col(agent).alias("parent_key"),
        )
    )


def publishable(mib: DataFrame) -> DataFrame:
    """Symbols that become metrics: current, readable, and no table or column of one at top level."""
    tables = mib.filter(F.col("table_name").isNotNull()).select(F.col("table_name").alias("name")).distinct()
    return (
        mib.filter((F.coalesce(F.col("status"), F.lit("current")) != "obsolete") & F.coalesce("readable", F.lit(False)))
        .filter(F.col("table_name").isNull())
        .join(tables, "name", "left_anti")
    )
