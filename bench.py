"""Times headline queries and prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES choose what."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINES = [
    "prepare", "merge_positions", "merge_same_entity", "cluster_nearby", "merge_linestrings", "build_elems",
    "query_area", "area_of_box", "category_of_places", "same_object_report", "classify_tags", "browse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    with tempfile.TemporaryDirectory(prefix="bench-") as work:
        spark = builder.config("spark.checkpoint.dir", work).getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start the engine before timing
        seconds = {}
        for name in names:
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
        spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
