"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, the best counts).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

HEADLINES = [
    "decode_passes",
    "decode_passes_narrow",
    "enrich_passes",
    "dedup_passes",
    "dedup_passes_ttl",
    "clean_passes_days",
    "station_window_count",
    "station_stats",
    "station_stats_30min",
    "plate_pairs",
    "plate_history",
    "clone_alerts",
    "upsert_stats",
    "traffic_stats",
    "clone_job",
]
STREAMS = ["stream_dedup_passes", "stream_station_stats", "stream_clone_alerts"]


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    from passgrid.catalog import batch, streams
    from passgrid.session import RECOMMENDED_CONF, use_local_scratch

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("passgrid-bench")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_scratch(spark)

    def seconds(query) -> float:
        begin = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    timings = {}
    for name in HEADLINES:
        timings[name] = round(min(seconds(batch.QUERIES[name]) for _ in range(runs)), 3)
    for name in STREAMS:
        timings[name] = round(seconds(streams.QUERIES[name]), 3)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
