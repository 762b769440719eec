"""Time every registered query once, after a warm-up, and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from fleetspan.plans import load_all
from fleetspan.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.files.maxPartitionBytes": "4m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One pass over a table warms the JVM and the parquet reader.
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    registry = load_all()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in only or registry:
        start = time.perf_counter()
        try:
            registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # noqa: BLE001 - one query must not hide the others
            failed[name] = str(error).splitlines()[0][:200]
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total wall time of all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir),
        "cpus": int(cpus),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
