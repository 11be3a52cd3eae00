"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (timed runs per query after one warm-up, default 3).
Each query is forced to completion with the no-op sink (a full execution,
no collect to the driver); the median of the timed runs is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from unilake.session import build_session, env_int  # noqa: E402


def _sf_of(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = env_int("BENCH_CPUS", 8)
    runs = env_int("BENCH_RUNS", 3)
    spark = build_session(
        f"local[{cpus}]", app="unilake-bench", shuffle_partitions=max(cpus * 2, 8),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.sql.files.maxPartitionBytes": os.environ.get("BENCH_SPLIT_BYTES",
                                                                   str(64 * 1024 * 1024))})

    from pyspark.sql import functions as F

    from unilake.plans import build
    from unilake.plans.queries import QUERIES

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def registered(name: str):
        return lambda: noop(QUERIES[name](spark, sf_dir))

    # each key is the registered query of that name, whole
    bench = {name: registered(name) for name in (
        "unified_activity", "check_unique", "quality_report", "change_set", "stream_refresh")}
    only = os.environ.get("BENCH_ONLY")
    if only:
        bench = {k: v for k, v in bench.items() if k in only.split(",")}

    times: dict[str, float] = {}
    all_runs: dict[str, list[float]] = {}
    for name, fn in bench.items():
        fn()  # warm-up
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(ts), 3)
        all_runs[name] = [round(t, 3) for t in ts]

    # freshness: seconds from a committed load to the published model (the
    # refresh stream's own latency, landing excluded), vs the target lag
    def land_to_publish() -> float:
        from unilake.session import fresh_dir
        from unilake.sources.adapters import source_registry
        from unilake.sources.landing import Lake
        from unilake.streaming.refresh import start_stream_refresh
        root = fresh_dir(spark, "bench-lake")
        lake = Lake(spark, root, namespace=f"bench_{root.rsplit('-', 1)[1]}_")
        lake.land_many(source_registry(spark, sf_dir, only={"sales", "web"}))
        t0 = time.perf_counter()
        q = start_stream_refresh(lake, ["int_unified_activity"], available_now=True,
                                 on_gate_failure="raise")
        q.awaitTermination()
        return time.perf_counter() - t0

    freshness = None
    if not only or "stream_refresh" in only.split(","):
        land_to_publish()   # warm-up
        freshness = round(statistics.median(land_to_publish() for _ in range(runs)), 3)

    activity_rows = build.unified_from_tables(spark, sf_dir, "int_unified_activity",
                                              loaded_at=False).agg(F.count(F.lit(1))).first()[0]
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf_of(sf_dir),
        "runs": all_runs,
        "freshness": {"land_to_publish_sec": freshness, "target_lag_sec": 60},
        "rows_per_sec": {"unified_activity": round(activity_rows / times["unified_activity"])
                         if "unified_activity" in times and times["unified_activity"] else None},
        "config": {"master": f"local[{cpus}]", "timed_runs": runs,
                   "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                   "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
                   "driver_memory": spark.sparkContext.getConf().get("spark.driver.memory")},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
