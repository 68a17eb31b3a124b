"""Structured Streaming over match documents as they arrive.

Match documents land over a season, one file per match. Two streaming jobs
cover them:

* ``start_landing`` lands every new document into the same Parquet layout as
  the batch landing (partitioned by competition season), through Spark's file
  sink: exactly-once, restartable from its checkpoint after a lost executor
  or driver. Unreadable documents go to a quarantine sink of their own. The
  two sinks are two queries over the same source, so each new document is
  parsed twice; that keeps both outputs exactly-once, which a single
  ``foreachBatch`` writer would not without idempotent paths.
* ``player_totals`` keeps every player's season measures up to date as a
  streaming aggregation. All measures are counts or exact decimal sums, so
  the state is one row per player (bounded by the number of players, not by
  the number of events) and the ratios are recomputed from the running
  counts on every update.

Checkpoints go under the shared ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.functions.columns import player_keys
from touchline.operators import aggregations as A
from touchline.operators import team as TM
from touchline.schemas import EVENT_DOCUMENT_SCHEMA
from touchline.session import checkpoint_dir
from touchline.sources.documents import CORRUPT, RAW_TEXT, NO_MATCH, REASON, match_id_from_path, parse_documents
from touchline.sources.landing import match_seasons


def read_event_stream(
    spark: SparkSession, events_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New match documents in ``events_dir`` as a stream of events (with
    ``match_id`` from the file name and the raw text of unreadable files)."""
    reader = spark.readStream.option("pathGlobFilter", "*.json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    texts = reader.text(events_dir, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    return parse_documents(texts, EVENT_DOCUMENT_SCHEMA).withColumn("match_id", match_id_from_path())


def _checkpoint(spark: SparkSession, name: str, given: str | None) -> str:
    return given or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def start_landing(
    stream: DataFrame,
    matches: DataFrame,
    path: str,
    quarantine_path: str,
    checkpoint: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Land a document stream to Parquet; returns (landing, quarantine) queries.

    The season of each event comes from a stream-static join with the match
    list, one row per match. A match that is not listed yet, or listed under two
    seasons, lands in the null season, where ``season.season_events`` finds it once its
    list names it. What does not parse, and events without a match id, go to the
    quarantine with the reason.
    """
    spark = stream.sparkSession
    base = _checkpoint(spark, "landing", checkpoint)
    seasons, _ = match_seasons(matches)
    good = (
        stream.filter(F.col(CORRUPT).isNull() & F.col("match_id").isNotNull())
        .drop(CORRUPT, REASON, "source_file")
        .join(seasons, on="match_id", how="left")
    )
    fields = [c for c in stream.columns if c not in (CORRUPT, REASON, "source_file", "match_id")]
    bad = stream.filter(F.col(CORRUPT).isNotNull() | F.col("match_id").isNull()).select(
        "source_file", "id",
        F.coalesce(CORRUPT, F.to_json(F.struct(*fields))).alias(RAW_TEXT),
        F.coalesce(REASON, F.lit(NO_MATCH)).alias("reason"),
    )

    def _trigger(w):
        if available_now:
            return w.trigger(availableNow=True)
        if processing_time:
            return w.trigger(processingTime=processing_time)
        return w

    land = _trigger(
        good.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{base}/events")
        .partitionBy("competition_id", "season_id")
        .outputMode("append")
    ).start()
    quarantine = _trigger(
        bad.writeStream.format("json")
        .option("path", quarantine_path)
        .option("checkpointLocation", f"{base}/quarantine")
        .outputMode("append")
    ).start()
    return land, quarantine


def player_totals(stream: DataFrame) -> DataFrame:
    """Running season table of every player (the all-player measures without
    the line-up), as a streaming aggregation; use output mode "update" or
    "complete"."""
    events = stream.filter(F.col(CORRUPT).isNull()) if CORRUPT in stream.columns else stream
    stats = TM.season_stats()
    types = sorted({s.event_type for s in stats})
    aggs = []
    for s in stats:
        aggs += A.stat_aggregates(s, within=A.type_is_sql(s.event_type))
    counted = (
        events.filter(F.col("type.name").isin(types) & F.col("player.id").isNotNull())
        .groupBy(*player_keys())
        .agg(*aggs)
    )
    computed: dict[str, str] = {}
    for s in stats:
        computed.update(A.stat_ratios_sql(s))
        for name, _ in s.minutes:
            computed[name] = f"coalesce({name}, 0.0)"
    columns = [c for c in counted.columns if c not in computed] + list(computed)
    return counted.selectExpr(*[f"{computed[c]} AS {c}" if c in computed else f"`{c}`" for c in columns])


def start_player_totals(
    stream: DataFrame,
    name: str,
    path: str,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep ``player_totals`` up to date under ``path``.

    Each trigger writes the players whose totals changed, and only those, to
    ``path/batch=<n>``; a batch that is run again after a failure overwrites its
    own folder. ``read_player_totals`` gives every player's newest row.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    w = (
        player_totals(stream)
        .writeStream.foreachBatch(write)
        .queryName(name)
        .outputMode("update")
        .option("checkpointLocation", _checkpoint(stream.sparkSession, f"totals-{name}", checkpoint))
    )
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_player_totals(spark: SparkSession, path: str) -> DataFrame:
    """Every player's totals as of the last batch that changed them."""
    rows = spark.read.parquet(path)
    keys = ["team_name", "team_id", "player_name", "player_id"]
    keys = [k for k in keys if k in rows.columns]
    newest = F.max_by(F.struct(*[c for c in rows.columns if c not in (*keys, "batch")]), "batch")
    return rows.groupBy(*keys).agg(newest.alias("row")).select(*keys, "row.*")
