"""Times the registered queries and prints one JSON line.

Landing the feed and building every model are timed once, from nothing. Each query is then run to
completion (noop sink): one warm-up and the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from leaguelake.plans import registry  # noqa: E402
from leaguelake.session import local_session  # noqa: E402
from leaguelake.sources.demo import demo  # noqa: E402
from leaguelake.sources.store import clear_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(query, spark) -> None:
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CORES, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    feed = demo(spark, FOLDER)

    def land() -> None:
        for table in registry.RAW_TABLES:
            feed.raw(table)

    def build() -> None:
        for name, df in feed.models.build().items():
            assert df.columns, name

    seconds = {"land_raw": timed(land), "build_models": timed(build)}
    for name, query in registry.QUERIES.items():
        run(query, spark)
        seconds[name] = statistics.median(timed(lambda q=query: run(q, spark)) for _ in range(RUNS))
    clear_session(spark)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(FOLDER).name.removeprefix("sf"),
        "cores": CORES,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
