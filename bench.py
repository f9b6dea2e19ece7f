"""Times the headline queries and prints one JSON line: second runs as `queries`, first runs as `cold`.

BENCH_SF_DIR names the data folder, BENCH_CPUS the cores, BENCH_ALL=1 runs every query.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "j06_window_diff",
    "z01_event_time_counts_batch",
    "z06_session_counts_batch",
    "w14_moving_window",
    "z04_late_split",
    "a01_word_count",
    "w01_word_changelog",
    "t01_top_n_words",
    "t03_match_top_k",
    "a02_partition_distribution",
    "a06_offset_table",
    "w02_latest_by_key",
    "w04_compact",
    "w05_retain",
    "w06_assign_offsets",
    "a14_latency_summary",
    "p07_anonymize",
    "w03_replacing_final",
    "s10_upsert_sink",
    "j01_dedup_gate",
    "j02_project_read_view",
    "j03_read_committed",
    "w12_fence_stale_writers",
    "z11_retry_pipeline_batch",
    "p20_replay_select",
    "z09_saga_orchestrator_batch",
    "z10_saga_conformance",
    "a16_wire_size_report",
    "p23_prepare_deliveries",
    "w09_failure_runs",
    "z07_streaming_word_count",
    "z14_cdc_anonymize_stream",
    "z17_stream_dedup",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    from tidemark.plans import registry

    queries = registry.queries()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = only.split(",")
    # Loads classes and compiles shared code paths before the first timing.
    queries["a02_partition_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold, warm = {}, {}
    for name in names:
        # Every column of every row is produced; nothing is collected and nothing is cached
        # between the two runs. The first one includes class loading and compilation.
        for times in (cold, warm):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    out = {
        "metric": "total_headline_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold_value": round(sum(cold.values()), 3),
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
