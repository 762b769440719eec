"""Members and state of a replica set's status document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State names by number, from 0.
STATES = [
    "STARTUP",
    "PRIMARY",
    "SECONDARY",
    "RECOVERING",
    "FATAL",
    "STARTUP2",
    "UNKNOWN",
    "ARBITER",
    "DOWN",
    "ROLLBACK",
    "SHUNNED",
]
_MEMBERS = "ARRAY<STRUCT<name: STRING, state: INT, self: BOOLEAN, health: DOUBLE, uptime: BIGINT>>"


def members(body: Column) -> Column:
    return F.from_json(F.get_json_object(body, "$.members"), _MEMBERS)


def self_member(body: Column) -> Column:
    """The member that wrote the document; null when none says so."""
    return F.try_element_at(F.filter(members(body), lambda m: m["self"]), F.lit(1))


def primary_member(body: Column) -> Column:
    """The first member in primary state; null when there is none."""
    return F.try_element_at(F.filter(members(body), lambda m: m["state"] == STATES.index("PRIMARY")), F.lit(1))


def state_name(number: Column) -> Column:
    """Name of a state number; UNKNOWN for a missing or unlisted one."""
    names = F.array(*[F.lit(s) for s in STATES])
    return F.coalesce(F.get(names, number.cast("int")), F.lit("UNKNOWN"))


def replica_state(body: Column) -> Column:
    return state_name(F.get_json_object(body, "$.myState").try_cast("int"))


def is_master(body: Column) -> Column:
    return replica_state(body) == "PRIMARY"
