"""Time every query on one data folder, fully materialised; prints one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default 8)
    BENCH_RUNS     runs per query after the first (default 1); the best run counts
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpusprep.plans.registry import queries  # noqa: E402
from corpusprep.session import local_session  # noqa: E402


def run(spark, function, folder: str) -> float:
    start = time.perf_counter()
    function(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or list(queries())
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    first, best, failed = {}, {}, {}
    for name in names:
        try:
            times = [run(spark, queries()[name], folder) for _ in range(1 + runs)]
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
            continue
        first[name], best[name] = round(times[0], 3), round(min(times), 3)
        print(f"{name:24} first {times[0]:7.2f}s  best {min(times):7.2f}s", file=sys.stderr, flush=True)
    report = {
        "metric": "total seconds over all queries, best run each",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first_run": first,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": cpus,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    if failed:
        report["failed"] = failed
    print(json.dumps(report))


if __name__ == "__main__":
    main()
