"""Time the headline queries and print one JSON line.

Every query is planned and run to the end with all its output columns; results go
to Spark's no-op sink. One untimed query warms the JVM first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "discovery_tracklets", "load_discoveries", "yearly_breakdown", "apparition_reach",
    "apparition_tracklets", "boxscore_objects", "boxscore", "alias_semi_join", "obs_summary",
    "obs_summary_all", "membership_wide", "disagreement_matrix", "station_discovery_profile",
    "station_obs_profile", "station_obs_profile_exact", "station_report", "detection_daily",
    "null_rates", "histogram_auto", "discovery_circumstances", "solar_elongation_histogram",
    "pairwise_codetection", "segment_arcs", "full_table_stats", "selective_count", "monthly_stats",
    "percentiles_disc", "self_join_count", "group_mean_lookup", "top_n_per_group", "period_change",
    "decode_obs80", "splice_uncertainty",
]


def main() -> None:
    from asterion.queries import QUERIES
    from asterion.session import build_session
    dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["discovery_tracklets"](spark, dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
