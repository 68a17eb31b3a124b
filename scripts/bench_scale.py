"""Benchmark over a larger input: the driver's events repeated with new ids.

Usage: python scripts/bench_scale.py [sf_dir] [times ...]
For each number of repetitions prints ONE JSON line: rows, seconds to land,
and seconds of the first and of the warm run of some queries. A plan that holds
at scale grows no faster than the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.plans.registry import queries  # noqa: E402
from touchline.session import checkpoint_dir, local_session  # noqa: E402
from touchline.sources.derived import landed_paths, read_driver_events  # noqa: E402

QUERIES = ["pass_accuracy", "all_player_stats", "heatmap_smooth", "season_events", "top_players"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cpus=os.environ.get("BENCH_CPUS", "8"), app="touchline-bench-scale")
    events = read_driver_events(spark, sf_dir)
    span = events.agg(F.max("event_id")).first()[0] + 1
    for times in map(int, sys.argv[2:] or ["1", "10"]):
        folder = f"{checkpoint_dir(spark)}/scale-{uuid.uuid4().hex}"
        copies = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        repeated = events.withColumn("copy", copies).withColumn("event_id", F.col("event_id") + F.col("copy") * F.lit(span))
        repeated.drop("copy").write.parquet(f"{folder}/events.parquet")
        out: dict = {"rows": spark.read.parquet(f"{folder}/events.parquet").count(), "times": times}
        t = time.perf_counter()
        landed_paths(spark, folder)
        out["land"] = round(time.perf_counter() - t, 2)
        for name in QUERIES:
            for run in ("first", "warm"):
                t = time.perf_counter()
                queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
                out[f"{name}_{run}"] = round(time.perf_counter() - t, 2)
        print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
