"""Wall-clock of the headline queries; prints one JSON line.

Per query: one warm-up, then the median of three runs. A run computes the whole
result and discards it (``noop`` sink), so nothing is lost to fetching rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import pyspark

from auditloom.session import build_session
from auditloom.workload import load
from auditloom.workload.binding import Tables

HEADLINE = (
    "entity_breakdown", "district_rollup", "class_top_owners", "owner_rollup", "surname_frequency", "type_deep_dive",
    "district_profile", "conditional_totals", "hierarchy_rollup", "topk_owners_value", "topk_per_group",
    "global_order_rank", "yoy_change", "preset_peer_join", "preset_scaled_filter", "preset_not_in", "paged_preview",
    "semi_join_keys", "share_matrix", "growth_cagr_nonnull", "tiered_flags", "audit_flags", "repeat_holdings",
    "top_holders", "anomaly_high_ratio", "blank_key_join", "shared_key_networks", "weighted_label_distribution",
    "record_assembly", "tax_book_records", "section_extract", "grid_header_promotion", "html_fields",
    "table_scoring", "class_breaks_quantile", "histogram_bins",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    wanted = names.split(",") if names else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    times: dict[str, float] = {}
    for name in wanted:
        samples = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            registry[name].build(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - started)
        times[name] = round(statistics.median(samples[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "shuffle_partitions": int(cpus),
        "runs": runs, "spark": pyspark.__version__}))
    spark.stop()


if __name__ == "__main__":
    main()
