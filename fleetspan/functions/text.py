"""Lines, key-value dumps and log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def body_lines(body: Column) -> Column:
    """Lines of a body; a final line break opens no further line."""
    closed = F.regexp_replace(body, r"(\r\n|\n|\r)\z", "")
    return F.when(F.length(body) > 0, F.split(closed, r"\r\n|\n|\r", -1))


def lines(df: DataFrame, body: str, number: str = "line_no", out: str = "line") -> DataFrame:
    """One row per line of ``body``, numbered from 0."""
    return df.select(*[c for c in df.columns if c != body], F.posexplode(body_lines(F.col(body))).alias(number, out))


# The two dialects of a statistics dump.
STAT_LINE = r"(?m)^STAT (\w+) (\S+)\r?$"
STAT_END = r"(?ms)^END\r?$.*"
INFO_LINE = r"(?m)^(?![#!])([^:=\s]+)\s*[:=][ \t]*([^\r\n]*?)\r?$"


def stat_pairs(body: Column, dialect: str) -> Column:
    """ARRAY<STRUCT(key, value)> of a dump: ``stat`` is ``STAT k v`` until END, ``info`` is ``k:v``."""
    if dialect == "stat":
        body, pattern = F.regexp_replace(body, STAT_END, ""), STAT_LINE
    elif dialect == "info":
        pattern = INFO_LINE
    else:
        raise ValueError(f"unknown dialect {dialect}")
    keys = F.regexp_extract_all(body, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(body, F.lit(pattern), F.lit(2))
    return F.arrays_zip(keys.alias("key"), values.alias("value"))


def parse_stats(df: DataFrame, body: str, dialect: str, keep: list[str]) -> DataFrame:
    """Long rows (keep..., pos, key, value) of a statistics dump."""
    return df.select(*keep, F.posexplode(stat_pairs(F.col(body), dialect)).alias("pos", "_p")).select(
        *keep, "pos", F.col("_p.key").alias("key"), F.col("_p.value").alias("value")
    )


# Log line patterns and the metrics published from them.
METRIC_LINE = r"group=(\w+), name=(\w+), (.*)"
EVENT_LINE = r"eventType=(\w+)"
LOG_NUMBER = r"(\w+)=(\d+(?:\.\d+)?)"
LOG_INTEGER = r"(\w+)=(\d+)"
LOG_METRICS = [
    "queue.tcpout_ssl_group.current_size",
    "thruput.thruput.total_k_processed",
    "queue.parsingqueue.current_size_kb",
    "thruput.index_thruput.total_k_processed",
]


def log_metrics(
    df: DataFrame, line: str, keep: list[str], compat: bool = False, published: Sequence[str] | None = None
) -> DataFrame:
    """Rows (keep..., metric, value) from ``group=G, name=N, k=v, ...`` lines; metric is ``G.N.k``.

    ``published`` names the metrics wanted, as in ``LOG_METRICS``; all by default.
    ``compat`` keeps the integer part of a number only.
    """
    col = F.col(line)
    number = LOG_INTEGER if compat else LOG_NUMBER
    rest = F.regexp_extract(col, METRIC_LINE, 3)
    pairs = F.arrays_zip(
        F.regexp_extract_all(rest, F.lit(number), F.lit(1)).alias("k"),
        F.regexp_extract_all(rest, F.lit(number), F.lit(2)).alias("v"),
    )
    prefix = F.concat_ws(".", F.regexp_extract(col, METRIC_LINE, 1), F.regexp_extract(col, METRIC_LINE, 2))
    found = (
        df.filter(col.rlike(METRIC_LINE))
        .select(*keep, prefix.alias("_prefix"), F.posexplode(pairs).alias("pair_no", "_p"))
        .select(
            *keep,
            "pair_no",
            F.concat_ws(".", "_prefix", "_p.k").alias("metric"),
            F.col("_p.v").try_cast("double").alias("value"),
        )
    )
    return found if published is None else found.filter(F.col("metric").isin(*published))


def is_log_event(line: Column) -> Column:
    """An event line that is no metric line."""
    return ~line.rlike(METRIC_LINE) & line.rlike(EVENT_LINE)


def scrub(text: Column, pattern: str) -> Column:
    """Text without any match of ``pattern``; an empty pattern changes nothing."""
    return F.regexp_replace(text, pattern, "") if pattern else text


def leading_integer_sum(output: Column) -> Column:
    """Sum of the integers that start a line; null when no line starts with one."""
    sizes = F.regexp_extract_all(output, F.lit(r"(?m)^(\d+)"), F.lit(1))
    return F.when(
        F.size(sizes) > 0,
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda acc, s: acc + s.try_cast("bigint")),
    )


# Command metrics as ``{args}|regex``.
NETSTAT_METRICS = {
    "TCP segments received": r"{-s}|(?s)Tcp:[^:]*?(\d+) segments rec",
    "TCP segments send out": r"{-s}|(?s)Tcp:[^:]*?(\d+) segments send",
    "TCP segments retransmitted": r"{-s}|(?s)Tcp:[^:]*?(\d+) segments retrans",
    "TCP bad segments": r"{-s}|(?s)Tcp:[^:]*?(\d+) bad seg",
}
UPTIME_METRICS = {
    "Number of days": r"{}|(\d+) day",
    "Number of users": r"{}|(\d+) user",
    "Load average last minute": r"{}|load \w+: ([\d.]+)",
}
