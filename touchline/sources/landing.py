"""Landing to Parquet and the JSON sink (K1).

Landing turns row-oriented JSON documents into columnar Parquet once, so
every statistic afterwards reads only the nested leaves it needs
(``type.name``, ``player.id``, ``pass.outcome.name``, ...) with its filters
pushed into the scan. Events are partitioned by competition season, not by
match, to keep files few at season scale. The unit of landing is the match: a
match that is landed again replaces itself and nothing else. Matches that the
list does not name, or names twice, wait in a pending table until a later
landing finds their season. Nothing that was read is dropped: what does not
parse is appended to a quarantine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.documents import CORRUPT, NO_MATCH, RAW_TEXT, split_corrupt
from touchline.sources.season import SEASON, match_partitions


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def match_seasons(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(match_id, competition_id, season_id) with one row per match, and the
    rows of matches that are listed under two seasons or under none."""
    listed = matches.select(
        "match_id",
        F.col("competition.competition_id").alias("competition_id"),
        F.col("season.season_id").alias("season_id"),
    ).distinct()
    known = F.col("competition_id").isNotNull() & F.col("season_id").isNotNull()
    per = listed.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.min(known).alias("known"))
    clear = per.filter("n = 1 and known and match_id is not null").select("match_id")
    return listed.join(clear, "match_id", "left_semi"), listed.join(clear, "match_id", "left_anti")


def _quarantine(bad: DataFrame, path: str) -> None:
    """Append rows (``raw_text`` and where it came from); none write no files."""
    if not bad.isEmpty():
        bad.write.mode("append").json(path)


def land_events(
    events: DataFrame,
    matches: DataFrame,
    path: str,
    quarantine_path: str | None = None,
    pending_path: str | None = None,
) -> None:
    """Land the matches of ``events`` under ``path``, partitioned by season.

    Every match of ``events`` replaces what was landed of it before, in
    whichever season or the pending table that was; all other matches stay. The
    season comes from the match list; matches without one are kept under
    ``pending_path`` and are landed with the next call whose list names them.
    Elements that did not parse, and events without a match id, are appended to
    ``quarantine_path``. Both default to folders beside ``path``, where the index
    of matches is kept, too. The new state
    of the seasons concerned is written aside first and then swapped in, season
    by season. One landing at a time may work on a path.
    """
    spark = events.sparkSession
    quarantine_path = quarantine_path or f"{path.rstrip('/')}-quarantine"
    pending_path = pending_path or f"{path.rstrip('/')}-pending"
    if CORRUPT in events.columns:
        events, bad = split_corrupt(events)
        _quarantine(bad, quarantine_path)
    lost = events.filter("match_id is null")
    source = F.col("source_file") if "source_file" in events.columns else F.lit(None).cast("string")
    _quarantine(
        lost.select(source.alias("source_file"), F.to_json(F.struct(*lost.columns)).alias(RAW_TEXT), F.lit(NO_MATCH).alias("reason")),
        quarantine_path,
    )
    events = events.filter("match_id is not null").drop("source_file", *SEASON)
    seasons, unclear = match_seasons(matches)
    _quarantine(
        unclear.select(F.lit(None).cast("string").alias("source_file"), F.to_json(F.struct(*unclear.columns)).alias(RAW_TEXT), F.lit("no single season").alias("reason")),
        quarantine_path,
    )
    arrived = events.select("match_id").distinct()
    waiting = None
    if _exists(spark, pending_path):
        waiting = spark.read.schema(_bucketed(events).schema).parquet(pending_path)
        named = waiting.drop("bucket").join(seasons, "match_id", "left_semi").join(arrived, "match_id", "left_anti")
        events = events.unionByName(named)
        arrived = events.select("match_id").distinct()
    incoming = events.join(seasons, "match_id", "left")
    staged = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex}"
    fresh = incoming.filter("competition_id is not null")
    merged, gone = fresh, None
    if _exists(spark, path):
        landed = spark.read.schema(fresh.schema).parquet(path)
        places = read_index(spark, path) if _exists(spark, index_path(path)) else match_partitions(landed)
        gone = places.join(arrived, "match_id", "left_semi").select(*SEASON).distinct()
        touched = gone.union(fresh.select(*SEASON).distinct()).distinct()
        old = landed.join(touched, SEASON, "left_semi").join(arrived, "match_id", "left_anti")
        merged = fresh.unionByName(old)
    write_events(merged, f"{staged}/events")
    # the pending table's buckets that hold a match of this landing are written anew
    pending = _bucketed(incoming.filter("competition_id is null").drop(*SEASON))
    touched_buckets = _bucketed(arrived).select("bucket").distinct()
    if waiting is not None:
        pending = pending.unionByName(waiting.join(touched_buckets, "bucket", "left_semi").join(arrived, "match_id", "left_anti"))
    pending.write.partitionBy("bucket").parquet(f"{staged}/pending")
    touched_buckets.write.parquet(f"{staged}/buckets")
    emptied = []
    if gone is not None:
        state = spark.read.schema(fresh.schema).parquet(f"{staged}/events").select(*SEASON).distinct()
        emptied = gone.join(state, SEASON, "left_anti").collect()  # seasons that lost their last match
    dynamic = {"partitionOverwriteMode": "dynamic"}
    spark.read.schema(fresh.schema).parquet(f"{staged}/events").sortWithinPartitions(*SEASON, "match_id", "index").write.mode(
        "overwrite"
    ).options(**dynamic).partitionBy(*SEASON).parquet(path)
    write_index(spark.read.schema(fresh.schema).parquet(f"{staged}/events"), index_path(path))
    for row in emptied:
        for table in (path, index_path(path)):
            _delete(spark, f"{table}/competition_id={row[0]}/season_id={row[1]}")
    staged_pending = spark.read.schema(pending.schema).parquet(f"{staged}/pending")
    if waiting is not None:
        buckets = spark.read.schema("bucket int").parquet(f"{staged}/buckets").join(staged_pending.select("bucket").distinct(), "bucket", "left_anti")
        for row in buckets.collect():  # at most PENDING_BUCKETS
            _delete(spark, f"{pending_path}/bucket={row[0]}")
    staged_pending.write.mode("overwrite").options(**dynamic).partitionBy("bucket").parquet(pending_path)
    _delete(spark, staged)


#: Folders of a pending table, whatever the number of matches in it.
PENDING_BUCKETS = 64


def _bucketed(events: DataFrame) -> DataFrame:
    """Events with the folder of the pending table that their match belongs to."""
    return events.withColumn("bucket", F.pmod(F.xxhash64("match_id"), F.lit(PENDING_BUCKETS)).cast("int"))


def write_events(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write events that carry ``competition_id`` and ``season_id`` columns.

    Rows are rebalanced by season first, so a season has few files however many
    tasks hold rows of it; adaptive execution splits a large season over tasks.
    Rows are sorted by match inside a file.
    """
    (
        events.hint("rebalance", *SEASON)
        .sortWithinPartitions(*SEASON, "match_id", "index")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SEASON)
        .parquet(path)
    )


def _good(df: DataFrame, path: str, quarantine_path: str | None) -> DataFrame:
    """The rows that parsed; the others go to the quarantine."""
    if CORRUPT in df.columns:
        df, bad = split_corrupt(df)
        _quarantine(bad, quarantine_path or f"{path.rstrip('/')}-quarantine")
    return df.drop("source_file")


def index_path(path: str) -> str:
    """Where the index of the events under ``path`` lies."""
    return f"{path.rstrip('/')}-index"


def write_index(events: DataFrame, path: str) -> None:
    """Write which matches lie in the partitions of ``events``; other partitions of the index stay."""
    match_partitions(events).hint("rebalance", *SEASON).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SEASON).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of the landed events under ``path``."""
    return spark.read.schema("match_id bigint, competition_id bigint, season_id bigint").parquet(index_path(path))


def land_table(df: DataFrame, path: str, mode: str = "overwrite", quarantine_path: str | None = None) -> None:
    """Write a small table (competitions, matches) to Parquet; rows that did
    not parse are appended to the quarantine."""
    _good(df, path, quarantine_path).write.mode(mode).parquet(path)


def land_matches(matches: DataFrame, path: str, mode: str = "overwrite", quarantine_path: str | None = None) -> None:
    """Write match documents partitioned by (competition_id, season_id), with
    per-partition overwrite: landing one season's match list replaces that
    season only. Rows that did not parse, or have no match id, are appended to
    the quarantine."""
    good = _good(matches, path, quarantine_path)
    lost = good.filter("match_id is null")
    _quarantine(
        lost.select(F.to_json(F.struct(*lost.columns)).alias(RAW_TEXT), F.lit(NO_MATCH).alias("reason")),
        quarantine_path or f"{path.rstrip('/')}-quarantine",
    )
    (
        good.filter("match_id is not null")
        .select(
            *good.columns,
            F.col("competition.competition_id").alias("competition_id"),
            F.col("season.season_id").alias("season_id"),
        )
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SEASON)
        .parquet(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: a result as JSON lines, written by the executors (nulls omitted)."""
    df.write.mode(mode).json(path)


def json_rows(df: DataFrame) -> DataFrame:
    """K1 as a DataFrame: one JSON object string per row, nulls omitted."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("json"))
