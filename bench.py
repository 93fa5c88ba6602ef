"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line.

A time is building the query (with the jobs it runs ahead, such as checkpoints
and size checks) plus producing every row of its result.

The test tables are single files with one row group, which one core reads
alone. They are first copied, unchanged, to as many files as there are cores;
that is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.inputs import TABLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from ledgerline.operators.lineage import staging_path  # noqa: E402

HEADLINE = [
    "signed_rollup", "measures_all", "level_arrays", "first_label", "nearest_ancestor",
    "three_key_join", "lookup_left", "any_key_override", "relabel_fanout", "spread_as_written",
    "prefix_strip", "clean_round", "daily_detail", "daily_consolidated", "monthly_detail",
    "monthly_consolidated",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # methods the JVM would not compile run as separate expressions instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = staging_path(spark, "bench")
    for name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(int(cpus)).write.parquet(f"{tables}/{name}.parquet")
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
