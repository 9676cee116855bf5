"""Times the registered queries and prints one JSON line.

Every query is run to a sink that discards its rows, after one untimed run of the first query that
starts the JVM. ``BENCH_QUERIES`` (comma separated) narrows the list.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gradeline import catalog  # noqa: E402
from gradeline.session import get_session  # noqa: E402


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(queries)
    run(queries["q19_popularity"], spark, sf_dir)
    seconds = {name: round(run(queries[name], spark, sf_dir), 3) for name in chosen}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
