"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of cores. Every
query is run to the end, all rows and columns, into Spark's noop sink. A time
covers building the DataFrame, planning and running. After one pass over all
queries to warm up come BENCH_RUNS timed passes; the median counts. No result
is cached between runs.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time

from encore.plans.registry import queries
from encore.session import local_session

HEADLINE = [
    "staging_events",
    "staging_songs",
    "load_events",
    "load_songs",
    "users",
    "artists",
    "songs",
    "time_dim",
    "songplays",
    "songplays_with_id",
    "star_join",
    "pipeline_counts",
    "layout_roundtrip",
    "fk_violations",
    "top_songs",
    "top_artists",
]


def run_once(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="bench-")  # one machine runs it all
    spark = local_session(
        cpus, **{"spark.checkpoint.dir": f"{scratch}/shared", "spark.sql.warehouse.dir": f"{scratch}/warehouse"}
    )
    registered = queries()
    timed = {name: [] for name in HEADLINE}
    for turn in range(runs + 1):
        for name in HEADLINE:
            took = run_once(registered[name], spark, sf_dir)
            if turn > 0:
                timed[name].append(took)
    seconds = {name: round(statistics.median(t), 3) for name, t in timed.items()}
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus) if cpus.isdigit() else cpus,
                "method": f"noop sink, median of {runs} after 1 warm-up",
            }
        )
    )


if __name__ == "__main__":
    main()
