"""Typing, scaling and decoding of extracted values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_numeric(text: Column) -> Column:
    """Double from text with thousands commas and white space removed; null when it is no number."""
    return F.regexp_replace(text, r"[,\s]", "").try_cast("double")


def typed_int(text: Column, default: int) -> Column:
    """Integer setting; the default stands in for a missing, empty or bad one."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")).try_cast("int"), F.lit(default))


def typed_string(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def typed_boolean(text: Column, default: bool = True) -> Column:
    """Boolean setting; only the word true counts as true."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(default)).otherwise(F.lower(text) == "true")


U32 = 1 << 32


def compose64(low: Column, high: Column) -> Column:
    """``low + high * 2**32`` of two unsigned 32-bit values, else null."""
    def unsigned(c: Column) -> Column:
        return c.between(0, U32 - 1)

    total = low.cast("decimal(20,0)") + high.cast("decimal(20,0)") * F.lit(U32).cast("decimal(20,0)")
    return F.when(unsigned(low) & unsigned(high), total.cast("decimal(20,0)"))


def decode_code(code: Column, codes: Column) -> Column:
    """Label of an integer code; the number itself where the code is unknown."""
    return F.coalesce(F.try_element_at(codes, code.cast("int")), code.cast("string"))


# Variable types as they appear in readings.
INTEGER_TYPES = ("Integer32", "UnsignedInteger32", "Counter32", "Gauge32")
TIME_TICKS = "TimeTicks"
TICK_MS = 10


def snmp_value(var_type: Column, raw: Column, data_type: Column, codes: Column) -> Column:
    """STRUCT(dvalue, svalue) of a reading by its variable type and the wanted data type.

    A code with a label becomes a trait, a trait keeps its text, octets are
    parsed as a number, ticks become milliseconds, the rest is widened.
    """
    is_coded = var_type.isin(*INTEGER_TYPES) & (F.coalesce(F.size(codes), F.lit(0)) > 0)
    as_text = F.when(is_coded, decode_code(raw.try_cast("int"), codes)).when(data_type == "trait", raw)
    number = raw.try_cast("double")
    as_number = F.when(is_coded | (data_type == "trait"), None).when(var_type == TIME_TICKS, number * TICK_MS).otherwise(
        number
    )
    return F.struct(as_number.alias("dvalue"), as_text.alias("svalue"))


GIB = 1024**3

# Attributes published under another name, with their factor.
STORAGE_RENAMES = {
    "BlocksTotal": ("BlocksTotal", 1),
    "FilesTotal": ("FilesTotal", 1),
    "PendingReplicationBlocks": ("PendingReplicationBlocks", 1),
    "ScheduledReplicationBlocks": ("ScheduledReplicationBlocks", 1),
    "TotalLoad": ("TotalLoad", 1),
    "UnderReplicatedBlocks": ("UnderReplicatedBlocks", 1),
    "CapacityRemainingGB": ("CapacityRemaining", GIB),
    "CapacityTotalGB": ("CapacityTotal", GIB),
    "CapacityUsedGB": ("CapacityUsed", GIB),
}
ACTIVITY_RENAMES = {
    "FilesCreated": ("FilesCreated", 1),
    "fsImageLoadTime": ("fsImageLoadTime", 1),
    "CorruptBlocks": ("BlocksCorrupted", 1),
    "Syncs_avg_time": ("SyncsAvgTime", 1),
    "Transactions_avg_time": ("TransactionsAvgTime", 1),
    "Transactions_num_ops": ("TransactionsNumOps", 1),
    "blockReport_avg_time": ("blockReportAvgTime", 1),
}


def renamed_metric(metric: Column, renames: dict[str, tuple[str, int]]) -> Column:
    """New name of a listed metric, null for one not listed."""
    out = F.lit(None).cast("string")
    for old, (new, _) in renames.items():
        out = F.when(metric == old, F.lit(new)).otherwise(out)
    return out


def rescaled_value(metric: Column, value: Column, renames: dict[str, tuple[str, int]]) -> Column:
    """Value of a listed metric in its published unit."""
    out = value
    for old, (_, factor) in renames.items():
        if factor != 1:
            out = F.when(metric == old, value * F.lit(float(factor))).otherwise(out)
    return out


def parse_http_date(text: Column) -> Column:
    """Timestamp of ``EEE, d MMM yyyy HH:mm:ss z``; null passes through."""
    return F.try_to_timestamp(
        F.regexp_replace(text, r"^\s*\p{Alpha}+,\s*", ""), F.lit("d MMM yyyy HH:mm:ss z")
    )


def iso_minute(ts: Column) -> Column:
    """ISO text to the minute with a numeric zone."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mmZ")


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def elapsed_ms(start: Column, end: Column, as_of: Column) -> Column:
    """End minus start, or ``as_of`` minus start while there is no end; null without a start."""
    return epoch_ms(F.coalesce(end, as_of)) - epoch_ms(start)


def recency_ms(ts: Column, as_of: Column) -> Column:
    return epoch_ms(as_of) - epoch_ms(ts)


def octets_text(octets: Column, charset: str = "UTF-8") -> Column:
    """Text of bytes; a byte the charset does not know becomes the replacement character.

    Spark's own decoding fails the job on such a byte, unless the session says
    otherwise, as ``session.prepare`` makes it do for the remaining charsets.
    """
    name = charset.upper().replace("_", "-")
    if name in ("UTF-8", "UTF8"):
        return F.make_valid_utf8(octets.cast("string"))
    if name in ("ASCII", "US-ASCII"):
        return F.regexp_replace(F.decode(octets, "ISO-8859-1"), r"[^\x00-\x7F]", "\ufffd")
    return F.decode(octets, charset)


def hex_bytes(literal: Column) -> Column:
    """Bytes of a ``0x...`` literal; other text gives its own bytes."""
    return F.when(literal.rlike("^0[xX][0-9A-Fa-f]*$"), F.unhex(F.substring(literal, 3, 1 << 30))).otherwise(
        F.encode(literal, "UTF-8")
    )


def ratio(part: Column, whole: Column) -> Column:
    """Part over whole; null where either is missing or the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
