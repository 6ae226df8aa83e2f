"""Headline queries, timed over all their columns; prints one JSON line.

``BENCH_SF_DIR`` is the scale to read, ``BENCH_CPUS`` the local cores. Every query runs
``BENCH_RUNS`` times and its median time counts. Zones and windows are stored once, before the
queries that share them; that ``setup`` is part of the total.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time

from cellwise.session import local_session
from workload.inputs import Scene
from workload.queries import QUERIES

HEADLINE = [
    "zonal_stats",
    "zonal_stats_leadtime",
    "zonal_stats_band",
    "zonal_stats_levels",
    "zonal_stats_large_zones",
    "stat_subset",
    "densify_zones",
    "rasterize",
    "zone_weights",
    "upsample_nearest",
    "point_in_zone",
    "simplify_rings",
    "polygon_meta",
    "quarantine",
    "upsert_stats",
    "compare_stats",
    "update_latest",
    "stream_update",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    shared = tempfile.mkdtemp(prefix="bench-")  # one machine: its disk is what all tasks share
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), shared=shared)
    began = time.perf_counter()
    Scene.of(spark, sf_dir)
    setup = time.perf_counter() - began
    times: dict[str, float] = {}
    for name in chosen:
        spent = []
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - began)
        times[name] = round(statistics.median(spent), 3)
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(setup + sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "setup": round(setup, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
