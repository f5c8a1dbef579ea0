"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3: the median after one warm-up run of each query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from fieldlake.plans import registry
from fieldlake.session import local_session

HEADLINE = [
    "infection_progress", "build_disease_record", "best_rule_argmax", "risk_score", "join_conditions_rules",
    "join_readings_weather", "join_fields_sensors", "join_labels_training", "alerts_from_disease",
    "avg_soil_by_field_time", "daily_field_summary", "field_counts", "disease_analytics", "sensor_trend_hourly",
    "dedupe_readings", "latest_per_sensor", "latest_n_readings", "rain_spells", "dq_missing_slots", "dq_range",
    "weather_payload_normalise", "temperature_baseline", "upsert_users", "permission_check",
    "stratified_split", "class_distribution", "dataset_summary", "augment_fanout", "pixel_stats", "channel_stats",
    "colour_histogram", "resize_pixels", "rotate", "route_hot_cold", "sink_cold_partitioned", "sink_processed_images",
    "stream_hot_cold", "stream_infection_state", "stream_trend_window", "stream_dedupe",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, shuffle_partitions=cores)
    jobs, _ = registry.load()

    def run(key: str) -> float:
        started = time.perf_counter()
        jobs[key](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for key in HEADLINE:
        run(key)
        times[key] = round(statistics.median(run(key) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
