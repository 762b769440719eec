"""Object identifiers: order, prefixes and encoded row indexes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetspan.functions.coerce import octets_text


def oid_array(oid: Column) -> Column:
    """Sub-identifiers as integers."""
    return F.transform(F.split(oid, r"\."), lambda s: s.try_cast("bigint"))


def oid_text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: p.cast("string")), ".")


def starts_with_oid(oid: Column, prefix: Column | str) -> Column:
    """Whether ``prefix`` is ``oid`` or one of its ancestors; an empty prefix is one of all."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return (prefix == "") | (oid == prefix) | oid.startswith(F.concat(prefix, F.lit(".")))


def drop_instance(oid: Column) -> Column:
    """Identifier of a scalar without its trailing ``.0``."""
    return F.regexp_replace(oid, r"\.0$", "")


def _text_of_bytes(parts: Column) -> Column:
    digits = F.transform(parts, lambda b: F.lpad(F.hex(b.cast("bigint")), 2, "0"))
    return octets_text(F.unhex(F.array_join(digits, "")))


def decode_index(index: Column, columns: list[tuple[str, str]]) -> Column:
    """MAP(name -> text) of a row index made of the given (name, type) columns.

    ``string`` is a length followed by that many bytes, ``int`` one
    sub-identifier, ``ip`` four, any other type takes what remains. The index
    is folded column by column; the state is the place reached and the texts so far.
    """
    # The one-element list binds the index, so that an expression for it is computed once.
    bound = F.array(index.cast("array<bigint>"))
    texts = F.transform(bound, lambda parts: _index_texts(parts, [kind for _, kind in columns]))[0]
    return F.map_from_arrays(F.array(*[F.lit(name) for name, _ in columns]), texts)


def _index_texts(index: Column, kinds: list[str]) -> Column:
    def step(state: Column, kind: Column) -> Column:
        at = state["at"]
        counted = F.when(kind == "string", F.coalesce(F.try_element_at(index, at).cast("int"), F.lit(0)))
        first = F.when(kind == "string", at + 1).otherwise(at)
        size = F.coalesce(
            counted, F.when(kind == "int", 1).when(kind == "ip", 4).otherwise(F.greatest(F.size(index) - at + 1, F.lit(0)))
        )
        piece = F.slice(index, first, F.greatest(size, F.lit(0)))
        text = F.when(kind == "string", _text_of_bytes(piece)).otherwise(F.nullif(oid_text(piece), F.lit("")))
        return F.struct((first + size).cast("int").alias("at"), F.array_append(state["texts"], text).alias("texts"))

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("texts"))
    return F.aggregate(F.array(*[F.lit(kind) for kind in kinds]), start, step, lambda state: state["texts"])


def index_name(index: Column, columns: list[tuple[str, str]]) -> Column:
    """Row name ``k=v, k=v`` of a decoded index, in column order."""
    pairs = F.map_entries(decode_index(index, columns))
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"])), ", ")


def ticks_text(ticks: Column) -> Column:
    """Hundredths of a second as ``D days, H:MM:SS.hh``."""
    days = F.floor(ticks / 8640000)
    hours = F.floor(ticks / 360000) % 24
    minutes = F.floor(ticks / 6000) % 60
    seconds = F.floor(ticks / 100) % 60
    day_text = F.when(days == 0, "").when(days == 1, "1 day, ").otherwise(F.concat(days.cast("string"), F.lit(" days, ")))
    return F.concat(day_text, F.format_string("%d:%02d:%02d.%02d", hours, minutes, seconds, ticks % 100))
