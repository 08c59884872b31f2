"""Time the queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hearback.queries import QUERIES  # noqa: E402
from hearback.session import build_session  # noqa: E402

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    # untimed: the first queries pay for class loading and compilation
    for name in ("table_sizes", "cancel_evidence"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()
