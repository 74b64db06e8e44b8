"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdclake_workload import queries as q  # noqa: E402
from cdclake.session import build_session  # noqa: E402

HEADLINE = [
    q.decode_changes, q.compact_per_operation, q.compact_latest, q.apply_changes, q.replace_table,
    q.apply_changes_partitioned, q.consolidate, q.consolidate_many_to_one, q.propagate_replace, q.propagate_patch,
    q.route_changes, q.union_changes, q.diff_schemas, q.latest_schemas, q.new_members, q.run_query, q.latest_per_key,
    q.run_progress, q.snapshot_table, q.stream_changes,
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "cdclake-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the JVM's compilers; not measured.
    q.apply_changes(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for query in HEADLINE:
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[query.__name__] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
