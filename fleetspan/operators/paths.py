"""Paths: size below a path, content of tables, open files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.text import body_lines
from fleetspan.functions.urls import path_prefixes, path_steps


def subtree_rollup(listing: DataFrame, depth: int | None = None, keep: Sequence[str] = (), path: str = "path") -> DataFrame:
    """Per ancestor path: size, files, directories and unreadable entries below it, itself included.

    ``depth`` limits how far below the ancestor an entry may lie. Sums are
    combined per task before the shuffle, so the root is no hot key.
    """
    steps = F.size(path_steps(F.col(path)))
    spread = listing.select(
        *keep, F.explode(path_prefixes(F.col(path))).alias("ancestor"), steps.alias("_steps"), "length", "is_dir", "readable"
    )
    if depth is not None:
        spread = spread.filter(F.col("_steps") - F.size(path_steps(F.col("ancestor"))) <= depth)
    is_dir = F.coalesce(F.col("is_dir"), F.lit(False))
    return spread.groupBy(*keep, "ancestor").agg(
        F.sum("length").alias("size"),
        F.count_if(~is_dir).alias("files"),
        F.count_if(is_dir).alias("directories"),
        F.count_if(~F.coalesce(F.col("readable"), F.lit(True))).alias("unreadable"),
    )


def path_times(listing: DataFrame, as_of: Column, mtime: str = "mtime") -> DataFrame:
    """Add modification time and recency in milliseconds."""
    ms = F.unix_millis(F.col(mtime).cast("timestamp"))
    return listing.withColumns(
        {"modification_ms": ms, "modification_recency_ms": F.unix_millis(as_of.cast("timestamp")) - ms}
    )


def table_summary(
    paths: DataFrame, table: str, path: str, measures: Sequence[str] = ("length", "file_count", "directory_count", "space_consumed")
) -> DataFrame:
    """Per table: each measure summed over the table's distinct paths."""
    once = paths.groupBy(table, path).agg(*[F.max(m).alias(m) for m in measures])
    return once.groupBy(table).agg(*[F.sum(m).alias(m) for m in measures])


# Fixed value: a file open for writing in a check's output.
OPEN_FILE = r"(/[/\S]+)[^/]+\bOPENFORWRITE\b"


def open_paths(output: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """Paths a check lists as open for writing, one row per mention."""
    found = F.regexp_extract_all(F.col("_line"), F.lit(OPEN_FILE), F.lit(1))
    return output.select(*keep, F.explode(body_lines(F.col(body))).alias("_line")).select(*keep, F.explode(found).alias("path"))


def open_files(opened: DataFrame, listing: DataFrame, as_of: Column, min_size: int = -1, min_age_ms: int = 60_000) -> DataFrame:
    """Open files larger than ``min_size`` and not modified for ``min_age_ms``."""
    ms = F.unix_millis(F.col("mtime").cast("timestamp"))
    old = ms < F.unix_millis(as_of.cast("timestamp")) - min_age_ms
    return opened.join(listing.select("path", "length", "mtime"), "path").filter((F.col("length") > min_size) & old)


def existing(paths: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """Paths that are in the listing."""
    return paths.join(listing.select(F.col("path").alias(path)).distinct(), path, "left_semi")
