"""Run one named statistic over landed tables and write it as JSON lines.

The batch form of the source's five routes (no server):

  spark-submit scripts/stat.py --landed s3://…/landed --out s3://…/out competitions
  spark-submit scripts/stat.py --landed … --out … matches --competition 9 --season 281
  spark-submit scripts/stat.py --landed … --out … events --match 3895302 --stat pass_acc [--player 40724]
  spark-submit scripts/stat.py --landed … --out … season --competition 9 --season 281 --stat shot
  spark-submit scripts/stat.py --landed … --out … season-team --competition 9 --season 281 \\
      --stat all --team-id 904 [--team-name "Bayer Leverkusen"]

``--landed`` is the output folder of scripts/land.py. Executors write the JSON
(null fields omitted, as the source's responses omit them); ``--show N``
also prints the first N rows.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from touchline.plans import catalog  # noqa: E402
from touchline.sources.landing import write_json  # noqa: E402


def build(spark: SparkSession, args: argparse.Namespace):
    landed = args.landed.rstrip("/")
    if args.route == "competitions":
        return catalog.competitions(spark.read.parquet(f"{landed}/competitions"), all=args.all)
    matches = spark.read.parquet(f"{landed}/matches")
    if args.route == "matches":
        return catalog.matches(matches, args.competition, args.season, all=args.all)
    events = spark.read.parquet(f"{landed}/events")
    if args.route == "events":
        return catalog.match_stat(events, args.match, args.stat, args.player, args.source_shape)
    if args.route == "season":
        return catalog.season_stat(
            events, matches, args.competition, args.season, args.stat, args.player, args.source_shape
        )
    return catalog.season_team_stat(
        events, matches, args.competition, args.season, args.stat, args.team_id, args.team_name
    )


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser()
    ap.add_argument("--landed", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--show", type=int, default=0)
    sub = ap.add_subparsers(dest="route", required=True)
    c = sub.add_parser("competitions")
    c.add_argument("--all", action="store_true")
    m = sub.add_parser("matches")
    m.add_argument("--competition", type=int, required=True)
    m.add_argument("--season", type=int, required=True)
    m.add_argument("--all", action="store_true")
    e = sub.add_parser("events")
    e.add_argument("--match", type=int, required=True)
    s = sub.add_parser("season")
    t = sub.add_parser("season-team")
    for p in (s, t):
        p.add_argument("--competition", type=int, required=True)
        p.add_argument("--season", type=int, required=True)
    for p in (e, s, t):
        p.add_argument("--stat", required=True)
    for p in (e, s):
        p.add_argument("--player", type=int, default=None)
        p.add_argument("--source-shape", action="store_true")
    t.add_argument("--team-id", type=int, default=0)
    t.add_argument("--team-name", default="")
    return ap


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("touchline-stat").getOrCreate()
    df = build(spark, args)
    write_json(df, args.out)
    if args.show:
        for row in df.limit(args.show).toJSON().collect():
            print(row)


if __name__ == "__main__":
    main()
