"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is fully materialised through Spark's ``noop`` sink (every column
of every row computed, nothing collected to the driver). A warm-up pass on the
smallest folder first pays the one-time JVM / code-generation cost.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "job_enrich_parcels",      # parcels x (zones, planning, forest, buildings) overlay
    "job_score_parcels",       # + same-use 0.5 m self join, signals, score
    "job_zone_phase_a",        # zones x (forest, planning)
    "job_zone_phase_b",        # envelope read + zones x (buildings, raisable)
    "job_communes_b",          # commune rollup
    "report_top_leads",        # top-k report
    "job_detect_changes",      # content hash, latest snapshot, change rows
    "join_spatial_inner",      # parcel x zone pairs with overlap area
    "geo_overlap_area",        # general-polygon exact path (edge-pair identity)
    "job_restriction_refresh",  # shortlist -> extracts -> replace keys -> rescore
]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from landlens.plans.queries import QUERIES
    from landlens.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)) if cpus.isdigit() else 16)
    warm = os.path.join(os.path.dirname(d), "sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(d):
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", d)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else d, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
