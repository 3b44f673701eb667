"""Wall time of every named query, and load throughput, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.bindings import registry  # noqa: E402
from quayside.bindings.common import events_landing  # noqa: E402
from quayside.session import build_session, default_cores  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = default_cores()


def run(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    only = sys.argv[1:]
    spark = build_session(
        "bench", f"local[{CORES}]", CORES,
        {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Once for the JVM, once to have the archives that the loads read.
    run(registry.QUERIES["top_suppliers_by_turnover"], spark)
    events_landing(spark, SF_DIR)
    seconds = {name: run(query, spark) for name, query in registry.QUERIES.items() if not only or name in only}
    print(json.dumps({
        "metric": "all_queries_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
        "cpus": CORES,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
