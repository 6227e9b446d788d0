"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forecourt.session import local_session, remove_runs  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "price_extract",
    "limit_check",
    "score_new_sources",
    "off_expired_trusted",
    "on_partial_trusted",
    "on_in_report_new",
    "off_stale_in_report",
    "source_replacement",
    "on_replacing_source",
    "count_race",
    "off_out_of_bounds",
    "off_old_diesel",
    "apply_changes",
    "price_visibility",
    "station_directory",
    "knn_pairs",
    "competitor_price_sources",
    "nearest_competitors",
    "registry_flatten",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8, app="bench")
    QUERIES["scan_prices"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        remove_runs(spark)
        print(name, seconds[name], file=sys.stderr)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
