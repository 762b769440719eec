"""Registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql.types import TimestampNTZType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.session import prepare

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the given tables under its own name."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(prepare(spark), sf_dir))

        if build.__name__ in REGISTRY:
            raise ValueError(f"query {build.__name__} is registered twice")
        REGISTRY[build.__name__] = Query(build.__name__, tuple(covers.split()), run, sql)
        return build

    return register


@dataclass(frozen=True)
class Tables:
    """The given tables by name; times without a zone are read as UTC."""

    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        zoneless = [f.name for f in df.schema if isinstance(f.dataType, TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df

    def stream(self, name: str) -> DataFrame:
        """The same table as a file stream. The last letter as a pattern lets the path be a file or a folder."""
        path = f"{self.sf_dir}/{name}.parque[t]"
        raw = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").schema
        df = self.spark.readStream.schema(raw).parquet(path)
        zoneless = [f.name for f in raw if isinstance(f.dataType, TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


class Streams(Tables):
    """The given tables as file streams."""

    def __getattr__(self, name: str) -> DataFrame:
        return self.stream(name)
