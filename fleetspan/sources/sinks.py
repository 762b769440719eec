"""Writers of results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_run(df: DataFrame, path: str, run: str, by: tuple[str, ...] = ()) -> None:
    """Rows of a numbered run, partitioned by ``by``; a run that is written again replaces itself.

    Every attempt writes a folder of its own and is then named in the run's
    commit. So readers never see a part of a run, nor one twice: not while it is
    written, not after a failure, not when it is repeated. Folders of
    attempts that no commit names can be removed at any time.
    """
    attempt = f"a-{uuid.uuid4().hex}"
    # The prefixes keep Spark from reading numbers or dates into folder names.
    df.write.partitionBy(*by).parquet(f"{path}/rows/run=r-{run}/attempt={attempt}")
    commit = df.sparkSession.createDataFrame([(attempt,)], "attempt STRING").withColumnRenamed("attempt", "committed")
    commit.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/run=r-{run}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed runs, with their ``run``."""
    commits = spark.read.parquet(f"{path}/commits").withColumnRenamed("committed", "attempt")
    # Both are folder names, so only the folders of committed attempts are read.
    rows = spark.read.parquet(f"{path}/rows").join(commits, ["run", "attempt"]).drop("attempt")
    return rows.withColumn("run", F.expr("substring(run, 3)"))


def write_report(df: DataFrame, path: str, mode: str = "append", ts: str = "ts", run: str | None = None) -> None:
    """Measurements and traits, partitioned by data type and day; with ``run`` as a run that may be repeated, see ``write_run``.

    Rows are gathered per partition value before writing and a day's rows are
    spread by resource, so neither many small files nor one huge task results.
    """
    dated = df.withColumn("date", F.to_date(ts))
    dated = dated.hint("rebalance", "data_type", "date")
    if run is not None:
        return write_run(dated, path, run, ("data_type", "date"))
    dated.write.mode(mode).partitionBy("data_type", "date").parquet(path)


def write_events(df: DataFrame, path: str, mode: str = "append", ts: str = "ts", run: str | None = None) -> None:
    """Events, partitioned by day; with ``run`` as a run that may be repeated, see ``write_run``."""
    dated = df.withColumn("date", F.to_date(ts)).hint("rebalance", "date")
    if run is not None:
        return write_run(dated, path, run, ("date",))
    dated.write.mode(mode).partitionBy("date").parquet(path)


def write_inventory(df: DataFrame, path: str) -> None:
    """A whole inventory snapshot."""
    df.write.mode("overwrite").parquet(path)
