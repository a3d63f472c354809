"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
The first query runs three times untimed, so that the JVM is warm. Each query then
runs once to warm up and BENCH_RUNS times into the `noop` sink; the median counts.
The whole jobs run once. Building the query, with any job it runs ahead, is inside the time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from plyscope.session import build_session  # noqa: E402

HEADLINE = (
    "move_analysis",
    "move_analysis_long_games",
    "side_aggregates",
    "phase_breakdown",
    "phase_drop",
    "performance_summary",
    "blunder_habits",
    "blunder_plies",
    "opening_repertoire",
    "name_openings",
    "games_to_review",
    "analysis_context",
    "game_plies",
    "moves_fact",
    "score_positions",
    "score_join",
    "game_numbering",
    "month_keys",
    "clean_games",
    "latest_snapshot",
    "ndjson_roundtrip",
)
WHOLE_JOBS = ("refresh", "incremental_refresh", "incremental_analysis")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp()},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for _ in range(3):
        QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE + WHOLE_JOBS:
        taken = []
        for _ in range(1 if name in WHOLE_JOBS else runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, median per query",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
