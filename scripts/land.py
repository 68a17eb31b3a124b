"""Land match documents into Parquet (the ingest job).

Usage:
  spark-submit scripts/land.py --events 's3://…/events/*.json' \\
      --matches 's3://…/matches/*/*.json' [--competitions s3://…/competitions.json] \\
      --out s3://…/landed [--mode append]

Writes <out>/events (partitioned by competition_id, season_id), <out>/matches,
<out>/competitions, and unreadable event documents to <out>/quarantine.
Uses the session's settings; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from touchline.sources.documents import (  # noqa: E402
    read_competitions,
    read_events,
    read_matches,
)
from touchline.sources.landing import land_events, land_matches, land_table  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--events", required=True)
    ap.add_argument("--matches", required=True)
    ap.add_argument("--competitions")
    ap.add_argument("--out", required=True)
    args = ap.parse_args()
    spark = SparkSession.builder.appName("touchline-land").getOrCreate()
    out = args.out.rstrip("/")
    quarantine = f"{out}/quarantine"
    if args.competitions:
        land_table(read_competitions(spark, args.competitions), f"{out}/competitions", quarantine_path=quarantine)
    land_matches(read_matches(spark, args.matches), f"{out}/matches", quarantine_path=quarantine)
    land_events(
        read_events(spark, args.events),
        spark.read.parquet(f"{out}/matches"),
        f"{out}/events",
        quarantine_path=quarantine,
        pending_path=f"{out}/pending",
    )


if __name__ == "__main__":
    main()
