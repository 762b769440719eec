"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Settings the library relies on; all can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed join be split even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A document with a repeated key is a document: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Bytes a charset does not know are replaced instead of failing the job.
    "spark.sql.legacy.codingErrorAction": "true",
}


def build_session(app: str = "fleetspan", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the library's settings; ``conf`` keys use ``_`` for ``.``-free names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A local folder is used
    only where that is unset and Spark itself runs in one local process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # Sized for a test run only: a cluster never reaches this line.
    folder = tempfile.mkdtemp(prefix="fleetspan-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or over ``path``, and read it back.

    Cuts lineage, fixes values that must not be computed twice, and survives
    the loss of any executor. ``spark`` is the session that reads.
    """
    spark = spark or df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], ddl: str | StructType) -> DataFrame:
    """A small table made on the driver; Spark knows its size and broadcasts it by itself."""
    schema = StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    arrow = to_arrow_schema(schema)
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
    return spark.createDataFrame(table, schema=schema)
