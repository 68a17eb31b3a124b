"""Queries that write documents and read them back: sources and sinks, end to end.

The test data holds tables only, so each query lets the executors write what a
provider would deliver (from the derived match events, over the whole table) and reads
it with the sources of ``touchline.sources``. Folders lie in the application's scratch folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators import aggregations as A
from touchline.operators import projections as P
from touchline.schemas import EVENT_DOCUMENT_SCHEMA, MATCH_SCHEMA
from touchline.session import scratch_folder
from touchline.sources import derived as D
from touchline.sources.arrays import scan_array_documents, write_json_array
from touchline.sources.documents import parse_elements, read_competitions, read_events, read_json_documents, read_matches, split_corrupt
from touchline.sources.drift import read_drifting

# Most events of a JSON document, a few megabytes; about a match of real data.
DOCUMENT_EVENTS = 4000
#: An event is damaged in the way of the list that stands at its id's remainder by this number, if there is one.
DAMAGE = 40


def flat(events: DataFrame, *more: str) -> DataFrame:
    """Scalar columns of events, for comparison as rows."""
    return events.select(
        *more,
        "match_id",
        "id",
        F.col("type.name").alias("type_name"),
        F.col("team.id").alias("team_id"),
        F.col("player.name").alias("player_name"),
        "minute",
        "second",
    )


#: Every field of an event that the documents fill, by the column that it is compared as.
LEAVES = {
    "match_id": "match_id", "id": "id", "event_index": "index", "type_name": "type.name", "team_id": "team.id", "team_name": "team.name",
    "player_id": "string(player.id)", "player_name": "player.name", "position_name": "position.name", "minute": "minute", "second": "second", "duration": "duration",
    "location_x": "get(location, 0)", "location_y": "get(location, 1)",
    "sub_in_id": "string(substitution.replacement.id)", "sub_in_name": "substitution.replacement.name", "sub_reason": "substitution.outcome.name",
    "end_x": "coalesce(get(pass.end_location, 0), get(shot.end_location, 0))", "end_y": "coalesce(get(pass.end_location, 1), get(shot.end_location, 1))",
    "end_z": "get(shot.end_location, 2)", "pass_outcome": "pass.outcome.name", "pass_body_part": "pass.body_part.name", "pass_type": "pass.type.name",
    "shot_outcome": "shot.outcome.name", "dribble_outcome": "dribble.outcome.name", "recovery_failure": "coalesce(ball_recovery.recovery_failure, false)",
    "block_present": "block IS NOT NULL", "block_deflection": "coalesce(block.deflection, false)", "block_offensive": "coalesce(block.offensive, false)", "block_save": "coalesce(block.save_block, false)",
    "block_counterpress": "coalesce(block.counterpress, false)", "foul_present": "foul_committed IS NOT NULL", "foul_type": "foul_committed.type.name",
    "foul_counterpress": "coalesce(foul_committed.counterpress, false)", "foul_offensive": "coalesce(foul_committed.offensive, false)", "foul_advantage": "coalesce(foul_committed.advantage, false)",
    "foul_penalty": "coalesce(foul_committed.penalty, false)", "foul_card": "foul_committed.card.name", "won_present": "foul_won IS NOT NULL",
    "won_advantage": "coalesce(foul_won.advantage, false)", "won_defensive": "coalesce(foul_won.defensive, false)", "won_penalty": "coalesce(foul_won.penalty, false)", "players_listed": "coalesce(size(tactics.lineup), 0)",
}


def leaves(events: DataFrame) -> DataFrame:
    """All that an event says, as scalar columns."""
    return events.selectExpr(*[f"{value} AS `{name}`" for name, value in LEAVES.items()])


def _chunked(events: DataFrame) -> DataFrame:
    """Events with the ``chunk`` of their match, of about ``DOCUMENT_EVENTS`` events, and the ``piece`` of it, of no more."""
    sizes = events.groupBy("match_id").agg(F.ceil(F.count("*") / DOCUMENT_EVENTS).alias("chunks"))
    dealt = events.join(sizes, "match_id").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))).drop("chunks")
    number = F.row_number().over(Window.partitionBy("match_id", "chunk").orderBy("id"))
    return dealt.withColumn("piece", F.floor((number - 1) / DOCUMENT_EVENTS))


def _write_elements(elements: DataFrame, path: str) -> None:
    """Texts ``element`` of a ``match_id``, ``chunk`` and ``piece`` as array documents, ``match_id=<id>/…``."""
    documents = elements.groupBy("match_id", "chunk", "piece").agg(F.concat(F.lit("["), F.array_join(F.collect_list("element"), ","), F.lit("]")).alias("value"))
    documents.select("match_id", "value").write.option("maxRecordsPerFile", 1).partitionBy("match_id").text(path)


def _element(schema) -> Column:
    return F.to_json(F.struct(*[f.name for f in schema]))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON documents of a match, read back. A large match has several."""
    path = scratch_folder(spark, "documents")
    _write_elements(_chunked(D.load_match_events(spark, sf_dir)).select("match_id", "chunk", "piece", _element(EVENT_DOCUMENT_SCHEMA).alias("element")), path)
    good, _ = split_corrupt(read_events(spark, path))
    return flat(good)


def event_array_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one ordered array document in parts, scanned in splits; with each event's place in it."""
    path = scratch_folder(spark, "array")
    write_json_array(D.load_match_events(spark, sf_dir).drop("competition_id", "season_id"), path, ["match_id", "id"])
    elements = scan_array_documents(spark, path, folders=True, position=True).withColumnRenamed("position", "place")
    good, _ = split_corrupt(parse_elements(elements, D.EVENT_SCHEMA))
    return flat(good, "place")


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: match lists as documents ``<competition>/<season>.json``; those of odd matches lack their ids, which the path gives."""
    path = scratch_folder(spark, "matches")
    known = (F.col("match_id") % 2) == 0
    matches = D.load_matches(spark, sf_dir).select(
        *[F.when(known, F.col(c)).alias(c) if c in ("competition", "season") else F.col(c) for c in MATCH_SCHEMA.fieldNames()],
        F.concat_ws("/", "competition.competition_id", "season.season_id").alias("file"),
    )
    listed = matches.groupBy("file").agg(F.to_json(F.collect_list(F.struct(*MATCH_SCHEMA.fieldNames()))).alias("value"))
    write_named(listed, path)
    good, _ = split_corrupt(read_matches(spark, f"{path}/*/*.json"))
    return P.matches(good).join(good.select("match_id", "competition.competition_id", "season.season_id"), "match_id")


def competition_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The competitions document, written and read back."""
    path = scratch_folder(spark, "competitions")
    competitions = D.competitions_from_matches(D.load_matches(spark, sf_dir))
    write_named(competitions.groupBy(F.lit("competitions").alias("file")).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")), path)
    good, _ = split_corrupt(read_competitions(spark, f"{path}/competitions.json"))
    return P.competitions(good)


def write_named(documents: DataFrame, path: str) -> None:
    """Each ``value`` as the file ``path/<file>.json``, written by the executors and renamed; a file for each competition season."""
    staged = f"{path}-staged"
    documents.select("value", F.regexp_replace("file", "/", "+").alias("file")).write.option("maxRecordsPerFile", 1).partitionBy("file").text(staged)
    rename_parts(documents.sparkSession, staged, path)


def rename_parts(spark: SparkSession, staged: str, path: str) -> None:
    """Give each ``file=<name>`` folder's only part the document's own name."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in fs.listStatus(p):
        name = folder.getPath().getName()
        if name.startswith("file="):
            (part,) = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            target = new(f"{path}/{name.removeprefix('file=').replace('%2B', '+').replace('+', '/')}.json")
            fs.mkdirs(target.getParent())
            fs.rename(part, target)


def document_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event documents with planted damage; what was not read, counted by match and reason."""
    path = scratch_folder(spark, "damaged")
    element = _element(EVENT_DOCUMENT_SCHEMA)
    number = F.col("id").try_cast("bigint") % DAMAGE
    damaged = (
        F.when(number == 1, F.regexp_replace(element, '"minute":\\d+', '"minute":"late"'))
        .when(number == 2, F.regexp_replace(element, '"type":\\{[^}]*\\}', '"type":"Pass"'))
        .when(number == 3, F.regexp_replace(element, '"team":\\{"id":\\d+', '"team":{"id":[1]'))
        .when(number == 4, F.regexp_replace(element, '"second":\\d+', '"second":tru'))
        .when(number == 5, F.lit("17"))
        .when(number == 6, F.lit(""))
        .when(number == 7, F.concat(F.lit("["), element, F.lit("]")))
        .when(number == 8, F.regexp_replace(element, '"minute":(\\d+)', '"minute":$1.5'))
        .otherwise(element)
    )
    _write_elements(_chunked(D.load_match_events(spark, sf_dir)).select("match_id", "chunk", "piece", damaged.alias("element")), path)
    _, bad = split_corrupt(read_json_documents(spark, path, EVENT_DOCUMENT_SCHEMA, split=True))
    match = F.regexp_extract("source_file", r"match_id=(\d+)", 1).cast("bigint")
    return bad.groupBy(match.alias("match_id"), "reason").agg(F.count("*").alias("n"))


def blocks_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of documents that never name a counterpress, read by their own schema: that kind has no columns."""
    path = scratch_folder(spark, "blocks")
    blocks = D.load_match_events(spark, sf_dir).filter("type.name = 'Block'").withColumn("block", F.when(F.col("block").isNotNull(), F.col("block").dropFields("counterpress")))
    fields = [c for c in EVENT_DOCUMENT_SCHEMA.fieldNames() if c in blocks.columns]
    _write_elements(_chunked(blocks).select("match_id", "chunk", "piece", F.to_json(F.struct(*fields)).alias("element")), path)
    return A.blocks(read_drifting(spark, path), by_schema=True, sort=False)


def drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: documents whose fields differ in kind from file to file, read by one merged schema.

    ``info.minute`` is a whole number in some and a fraction in others, ``info.outcome`` an object in
    some and a text in others, ``info.x`` is missing in most.
    """
    path = scratch_folder(spark, "drift")
    kind, outcome = F.col("type.name"), F.coalesce(F.col("shot.outcome.name"), F.lit("none"))
    info = (
        F.when(kind == "Pass", F.to_json(F.struct("minute", F.col("location")[0].alias("x"))))
        .when(kind == "Shot", F.to_json(F.struct((F.col("minute") + F.lit(0.5)).alias("minute"), F.struct(outcome.alias("name")).alias("outcome"))))
        .when(kind == "Pressure", F.to_json(F.struct("minute", F.col("player.name").alias("outcome"))))
    )
    events = _chunked(D.load_match_events(spark, sf_dir)).filter(info.isNotNull())
    element = F.concat(F.lit('{"id":"'), "id", F.lit('","match":'), "match_id", F.lit(',"info":'), info, F.lit("}"))
    # a document holds one kind of event, so each has a schema of its own
    _write_elements(events.select("match_id", "chunk", F.concat_ws("-", "piece", kind).alias("piece"), element.alias("element")), path)
    rows = read_drifting(spark, path)
    return rows.select(F.col("match").alias("match_id"), "id", F.col("info.minute").alias("minute"), F.col("info.x").alias("x"), F.col("info.outcome").alias("outcome"))
