"""Batch readers of captured inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspan import schema
from fleetspan.functions.coerce import octets_text
from fleetspan.functions.text import lines


def read_table(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """A captured table with its known schema: no inference pass over the data."""
    return spark.read.format(fmt).schema(ddl).load(path)


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schema.RESPONSES, fmt)


def read_traps(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schema.TRAPS, fmt)


def read_varbinds(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schema.VARBINDS, fmt)


def read_command_runs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schema.COMMAND_RUNS, fmt)


def read_processes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schema.PROCESSES, fmt)


def read_attributes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schema.ATTRIBUTES, fmt)


def read_bodies(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """Whole files as (resource_key, body, content_length, last_modified)."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("resource_key"),
        octets_text(F.col("content"), charset).alias("body"),
        F.col("length").alias("content_length"),
        F.unix_millis("modificationTime").alias("last_modified"),
    )


def read_lines(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """Lines of whole files, numbered from 0 within each."""
    return lines(read_bodies(spark, path, charset).select("resource_key", "body"), "body")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of splittable logs as (file, block, seq, line); (block, seq) orders the lines of a file.

    Large files are read in many tasks: the block's start comes from the split,
    the sequence from the row's place in it.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` as (path, length, mtime); their contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "length", F.col("modificationTime").alias("mtime"))
    )


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, ddl: str) -> DataFrame:
    """Row-tagged elements of XML files."""
    return spark.read.format("xml").schema(ddl).option("rowTag", row_tag).load(path)


# Defaults of a metric that does not state them.
DEFAULT_INTERVAL_MS = 600_000
DEFAULT_DATA_TYPE = "measurement"


def read_definitions(spark: SparkSession, path: str, resource_type: str | None = None) -> DataFrame:
    """Metric definitions of descriptor files; ``resource_type`` defaults to the enclosing file's name."""
    ddl = (
        "_property STRING, _dataType STRING, _measurementType STRING, _units STRING, _defaultInterval BIGINT, "
        "_displayType STRING, _defaultOn BOOLEAN, _description STRING"
    )
    rows = read_xml_rows(spark, path, "metric", ddl)
    kind = F.lit(resource_type) if resource_type else F.regexp_extract("_metadata.file_name", r"^([^.]+)", 1)
    return rows.select(
        kind.alias("resource_type"),
        F.col("_property").alias("metric"),
        F.coalesce("_dataType", F.lit(DEFAULT_DATA_TYPE)).alias("data_type"),
        F.coalesce("_measurementType", F.lit("dynamic")).alias("measurement_type"),
        F.coalesce("_units", F.lit("none")).alias("units"),
        F.coalesce("_defaultInterval", F.lit(DEFAULT_INTERVAL_MS)).cast("bigint").alias("interval_ms"),
        F.coalesce("_displayType", F.lit("detail")).alias("display_type"),
        F.coalesce("_defaultOn", F.lit(False)).alias("default_on"),
    )


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT per file; a file whose root is no object or no JSON gives null."""
    body = F.col("body")
    parsed = F.try_parse_json(body)
    return read_bodies(spark, path).select("resource_key", "body", F.when(body.rlike(r"^\s*\{"), parsed).alias("document"))


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A relational query run by its own database."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def metastore_tables(tables: DataFrame, partitions: DataFrame, limit: int | None = None) -> DataFrame:
    """Names of the tables that have partitions, with their number, in name order, all of them unless ``limit`` is given."""
    named = (
        tables.join(partitions, "tbl_id").groupBy("tbl_name").agg(F.count(F.lit(1)).alias("partitions")).orderBy("tbl_name")
    )
    return named if limit is None else named.limit(limit)


def table_locations(
    tables: DataFrame, partitions: DataFrame, storage: DataFrame, names: Sequence[str] | None = None
) -> DataFrame:
    """Storage locations of the partitions of the named tables, or of all."""
    picked = tables if names is None else tables.filter(F.col("tbl_name").isin(*names))
    return picked.join(partitions, "tbl_id").join(storage, "sd_id").select("tbl_name", "location")


def tail_lines(lines_with_pos: DataFrame, offsets: DataFrame) -> DataFrame:
    """Lines at or after each file's stored offset; a file that shrank is read from its start.

    ``lines_with_pos`` has (file, length, pos, line), ``offsets`` (file, offset).
    """
    start = F.when(F.coalesce("offset", F.lit(0)) > F.col("length"), 0).otherwise(F.coalesce("offset", F.lit(0)))
    return lines_with_pos.join(offsets, "file", "left").filter(F.col("pos") >= start).drop("offset")


def next_offsets(lines_with_pos: DataFrame) -> DataFrame:
    """Offsets to store after all lines were read."""
    return lines_with_pos.groupBy("file").agg(F.max("length").alias("offset"))


# --- tail by byte offset -------------------------------------------------------

#: What a run leaves for the next one: bytes read of each file, and how the file began.
LEDGER = "file STRING, offset BIGINT, head STRING"
#: Code points of a first line that tell files apart.
HEAD = 256


def read_lines_at(spark: SparkSession, path: str | Sequence[str], file: Column | None = None) -> DataFrame:
    """Rows (file, size, line, start, end) of text files: every line with the byte at which it begins and the one after its end.

    ``file`` names a file by its ``path``, if not by the whole path. Lines end at
    line feeds. Spark reads a file in splits, whose first lines begin somewhere
    behind the split's start; so a line begins where the bytes of the splits
    before it and of the lines before it in its own split end. Only the splits'
    sums are ordered per file, and the lines within a split, which is of bounded size.
    """
    meta = F.col("_metadata")
    raw = spark.read.text(path if isinstance(path, str) else list(path), lineSep="\n")
    lines = raw.withColumn("path", meta["file_path"]).select(
        (F.col("path") if file is None else file).alias("file"),
        meta["file_size"].alias("size"), meta["file_block_start"].alias("_block"),
        F.monotonically_increasing_id().alias("_n"), F.col("value").alias("line"), (F.octet_length("value") + 1).cast("bigint").alias("_bytes"),
    )
    splits = lines.groupBy("file", "_block").agg(F.sum("_bytes").alias("_sum"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("file", "_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lines.withColumn("_sum", F.sum("_bytes").over(inside)).join(splits, ["file", "_block"])
    end = F.col("_base") + F.col("_sum")
    # The last line of a file may lack its line feed.
    return placed.select("file", "size", "line", (end - F.col("_bytes")).alias("start"), F.least(end, "size").alias("end"))


def tail_files(lines: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New lines (file, line, start) of ``read_lines_at`` rows since the ledger, and the ledger of the files as they are now.

    A file goes on at its offset. It is read from its start when it is shorter
    than that, or begins otherwise than it did: it was rotated. A file that the
    ledger does not know goes on where the one file stood that began alike and
    is no longer in its place: it was renamed. A line that had been read in part
    gives the rest. The ledger that is returned keeps files that are gone, as they may come back under
    another name.
    """
    head = F.substring("line", 1, HEAD)
    # One row per file.
    now = lines.groupBy("file").agg(F.max("size").alias("size"), F.max(F.when(F.col("start") == 0, head)).alias("head"))
    known = ledger.select("file", F.col("offset").alias("_offset"), F.col("head").alias("_head"))
    here = now.join(known, "file", "left")
    same = F.coalesce(F.startswith("head", F.col("_head")), F.lit(False))
    here = here.withColumn("_same", same)
    left = known.join(here.filter("_same").select("file"), "file", "left_anti")
    moved = left.groupBy(F.col("_head").alias("head")).agg(F.count(F.lit(1)).alias("_files"), F.max("_offset").alias("_moved")).filter("_files = 1")
    here = here.join(moved, "head", "left")
    begin = F.when(F.col("_same"), F.col("_offset")).when(F.col("_offset").isNull(), F.col("_moved"))
    begin = F.when(begin <= F.col("size"), begin).otherwise(F.lit(0))
    begins = here.select("file", begin.alias("_begin"))
    new = lines.join(begins, "file").filter(F.col("end") > F.col("_begin"))
    cut = F.col("_begin") - F.col("start")
    rest = F.decode(F.substring(F.encode("line", "utf-8"), (cut + 1).cast("int"), F.octet_length("line")), "utf-8")
    new = new.select("file", F.when(cut > 0, rest).otherwise(F.col("line")).alias("line"), F.greatest("start", "_begin").alias("start"))
    gone = ledger.join(now.select("file"), "file", "left_anti").select("file", "offset", "head")
    return new, now.select("file", F.col("size").alias("offset"), "head").unionByName(gone)
