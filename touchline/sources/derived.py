"""Match events derived from the driver's ``events`` table.

The test data has no match documents, so match events are derived from the
``events`` table by arithmetic that Spark and DuckDB evaluate identically
(FIXTURES.md §3). The flat columns are then packed into the nested event
schema, so the statistics run on the real nested shape while an independent
SQL oracle can read the same facts from the flat columns.

Everything here is a plain projection of ``events`` (plus one bounded
aggregation for line-ups), so it scales with the table and needs no driver
round trip.
"""

from __future__ import annotations

import hashlib
import re
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import EVENT_SCHEMA, MATCH_SCHEMA
from touchline.session import checkpoint_dir
from touchline.sources.landing import index_path, land_table, read_index, write_events, write_index

# ---------------------------------------------------------------------------
# The derivation of FIXTURES.md §3, in its order. Each expression
# may use ``events`` columns and any name defined above it. ``{k}`` is the one
# engine-specific piece (see K_EXPR).
# ---------------------------------------------------------------------------
FLAT_COLUMNS: list[tuple[str, str]] = [
    ("k", "{k}"),
    ("v", "cast(round(value*100) as bigint)"),
    ("minute", "cast(hour(ts)*60+minute(ts) as bigint)%106"),
    ("second", "cast(second(ts) as bigint)"),
    ("player_id", "user_id"),
    ("t", "k%20"),
    ("h", "(event_id*31+v)%1000"),
    ("team_id", "900+player_id%6"),
    ("team_name", "concat('Team ',cast(team_id as string))"),
    ("player_name", "concat('Player ',cast(player_id as string))"),
    ("match_id", "3895000+cast(floor((player_id%6)/2) as bigint)*10+event_id%5"),
    ("competition_id", "9"),
    ("season_id", "case when event_id%5<3 then 281 else 282 end"),
    ("type_name", "case when t<=6 then 'Pass' when t<=9 then 'Carry' when t<=11 then 'Shot' when t=12 then 'Dribble' when t=13 then 'Ball Recovery' when t=14 then 'Block' when t=15 then 'Foul Committed' when t=16 then 'Foul Won' when t=17 then 'Pressure' when t=18 then 'Substitution' else 'Ball Receipt*' end"),
    ("duration", "case when t<=9 then cast(v as double)/100 end"),
    ("location_x", "case when t<18 then cast((h*7)%1200 as double)/10 end"),
    ("location_y", "case when t<18 then cast((h*13)%800 as double)/10 end"),
    ("pass_outcome", "case when t<=6 and h%5=0 then case h%3 when 0 then 'Incomplete' when 1 then 'Out' else 'Pass Offside' end end"),
    ("pass_body_part", "case when t<=6 then case h%8 when 0 then 'Right Foot' when 1 then 'Left Foot' when 2 then 'Head' when 3 then 'Drop Kick' when 4 then 'Keeper Arm' when 5 then 'Other' when 6 then 'No Touch' end end"),
    ("pass_type", "case when t<=6 then case when h%8=7 then 'Recovery' when h%9=0 then 'Throw-in' when h%11=0 then 'Recovery' end end"),
    ("end_x", "case when t<=6 or t in (10,11) then cast((h*17)%1200 as double)/10 end"),
    ("end_y", "case when t<=6 or t in (10,11) then cast((h*19)%800 as double)/10 end"),
    ("end_z", "case when t in (10,11) and h%3<>0 then cast(h%50 as double)/10 end"),
    ("shot_outcome", "case when t in (10,11) then case h%8 when 0 then 'Goal' when 1 then 'Saved' when 2 then 'Saved off T' when 3 then 'Saved to Post' when 4 then 'Blocked' when 5 then 'Off T' when 6 then 'Post' else 'Wayward' end end"),
    ("dribble_outcome", "case when t=12 then case when h%3<>0 then 'Complete' else 'Incomplete' end end"),
    ("recovery_failure", "case when t=13 and h%6=0 then true end"),
    ("block_present", "t=14 and h%3<>0"),
    ("block_deflection", "case when block_present and h%4=0 then true end"),
    ("block_offensive", "case when block_present and h%5=0 then true end"),
    ("block_save", "case when block_present and h%7=0 then true end"),
    ("block_counterpress", "case when block_present and h%2=0 then true end"),
    ("foul_present", "t=15 and h%4<>0"),
    ("foul_type", "case when foul_present then case h%7 when 1 then '6 Seconds' when 2 then 'Backpass Pick' when 3 then 'Dangerous Play' when 4 then 'Dive' when 5 then 'Foul Out' when 6 then 'Handball' end end"),
    ("foul_counterpress", "case when foul_present and h%2=1 then true end"),
    ("foul_offensive", "case when foul_present and h%3=0 then true end"),
    ("foul_advantage", "case when foul_present and h%5=0 then true end"),
    ("foul_penalty", "case when foul_present and h%11=0 then true end"),
    ("foul_card", "case when foul_present and h%6=1 then 'Yellow Card' end"),
    ("won_present", "t=16 and h%4<>0"),
    ("won_advantage", "case when won_present and h%5=0 then true end"),
    ("won_defensive", "case when won_present and h%3=0 then true end"),
    ("won_penalty", "case when won_present and h%11=0 then true end"),
    ("position_name", "case (player_id+match_id)%5 when 0 then 'Goalkeeper' when 1 then 'Right Back' when 2 then 'Center Back' when 3 then 'Left Wing' else 'Center Forward' end"),
    ("jersey_number", "1+cast(floor(player_id/6) as bigint)"),
    ("sub_in_id", "case when t=18 then player_id+6 end"),
    ("sub_in_name", "case when t=18 then concat('Player ',cast(player_id+6 as string)) end"),
    ("sub_reason", "case when t=18 then case when h%2=0 then 'Tactical' else 'Injury' end end"),
]

K_EXPR = {
    "spark": "cast(get_json_object(props,'$.k') as int)",
    "duckdb": "cast(json_extract_string(props,'$.k') as int)",
}

# Line-up events carry at most this many players each, so no array grows with
# the data (real line-ups hold eleven).
LINEUP_CHUNK = 64


def _layers() -> list[list[tuple[str, str]]]:
    """Group FLAT_COLUMNS so no expression reads a name from its own layer."""
    layers: list[list[tuple[str, str]]] = [[]]
    current: set[str] = set()
    for name, expr in FLAT_COLUMNS:
        # A name followed by "(" is a function call (minute(ts)), not a column.
        uses = {n for n in current if re.search(rf"\b{re.escape(n)}\b(?!\s*\()", expr)}
        if uses:
            layers.append([])
            current = set()
        layers[-1].append((name, expr))
        current.add(name)
    return layers


def flat_match_events(events: DataFrame) -> DataFrame:
    """The flat columns of FIXTURES §3 next to the ``events`` columns."""
    df = events
    for layer in _layers():
        df = df.selectExpr(
            "*", *[f"{expr.format(k=K_EXPR['spark'])} AS `{name}`" for name, expr in layer]
        )
    return df


def flat_match_events_sql(source: str = "events") -> str:
    """DuckDB SQL body (a SELECT) computing the same flat columns."""
    sql = f"SELECT * FROM {source}"
    for i, layer in enumerate(_layers()):
        cols = ", ".join(
            f'{expr.format(k=K_EXPR["duckdb"])} AS "{name}"' for name, expr in layer
        )
        sql = f"SELECT *, {cols} FROM ({sql}) AS l{i}"
    return sql


# ---------------------------------------------------------------------------
# Packing the flat columns into nested events.
# ---------------------------------------------------------------------------


def _ref(name: str, id_col: str | None = None) -> Column:
    """A name/id struct, null when the name is null."""
    rid = F.col(id_col) if id_col else F.lit(None).cast(T.LongType())
    return F.when(F.col(name).isNotNull(), F.struct(rid.alias("id"), F.col(name).alias("name")))


def _shape(columns: dict[str, Column]) -> list[Column]:
    """Columns in EVENT_SCHEMA order; fields not given become typed nulls."""
    out = []
    for field in EVENT_SCHEMA.fields:
        col = columns.get(field.name, F.lit(None))
        out.append(col.cast(field.dataType).alias(field.name))
    return out


def _ref_sql(name: str, id_col: str | None = None) -> str:
    """SQL of a name/id struct, null when the name is null."""
    rid = id_col or "CAST(NULL AS BIGINT)"
    return f"CASE WHEN {name} IS NOT NULL THEN named_struct('id', {rid}, 'name', {name}) END"


def _struct_sql(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


# Player events packed from the flat columns, as SQL over the flat frame.
PLAYER_EVENT_SQL: dict[str, str] = {
    "id": "CAST(event_id AS STRING)",
    "index": "event_id",
    "type": "named_struct('id', CAST(NULL AS BIGINT), 'name', type_name)",
    "team": _ref_sql("team_name", "team_id"),
    "player": _ref_sql("player_name", "player_id"),
    "position": _ref_sql("position_name"),
    "minute": "minute",
    "second": "second",
    "duration": "duration",
    "location": "CASE WHEN location_x IS NOT NULL THEN array(location_x, location_y) END",
    "substitution": "CASE WHEN type_name = 'Substitution' THEN "
    + _struct_sql(replacement=_ref_sql("sub_in_name", "sub_in_id"), outcome=_ref_sql("sub_reason"))
    + " END",
    "pass": "CASE WHEN type_name = 'Pass' THEN "
    + _struct_sql(
        end_location="array(end_x, end_y)",
        outcome=_ref_sql("pass_outcome"),
        body_part=_ref_sql("pass_body_part"),
        type=_ref_sql("pass_type"),
    )
    + " END",
    "shot": "CASE WHEN type_name = 'Shot' THEN "
    + _struct_sql(
        end_location="CASE WHEN end_z IS NULL THEN array(end_x, end_y) "
        "ELSE array(end_x, end_y, end_z) END",
        outcome=_ref_sql("shot_outcome"),
    )
    + " END",
    "dribble": "CASE WHEN type_name = 'Dribble' THEN "
    + _struct_sql(outcome=_ref_sql("dribble_outcome"))
    + " END",
    "ball_recovery": "CASE WHEN recovery_failure IS NOT NULL THEN "
    + _struct_sql(recovery_failure="recovery_failure")
    + " END",
    "block": "CASE WHEN block_present THEN "
    + _struct_sql(
        deflection="block_deflection",
        offensive="block_offensive",
        save_block="block_save",
        counterpress="block_counterpress",
    )
    + " END",
    "foul_committed": "CASE WHEN foul_present THEN "
    + _struct_sql(
        type=_ref_sql("foul_type"),
        counterpress="foul_counterpress",
        offensive="foul_offensive",
        advantage="foul_advantage",
        penalty="foul_penalty",
        card=_ref_sql("foul_card"),
    )
    + " END",
    "foul_won": "CASE WHEN won_present THEN "
    + _struct_sql(defensive="won_defensive", advantage="won_advantage", penalty="won_penalty")
    + " END",
    "match_id": "match_id",
}


def _player_event_sql() -> list[str]:
    """The player-event columns in EVENT_SCHEMA order, each cast to its field
    type (fields not packed are typed nulls)."""
    return [
        f"CAST({PLAYER_EVENT_SQL.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in EVENT_SCHEMA.fields
    ]


def _lineup_events(flat: DataFrame, extra: list[str]) -> DataFrame:
    """``Starting XI`` events: one per match, team and block of player ids.

    ``collect_set`` deduplicates map-side, and the chunk key bounds every
    array at LINEUP_CHUNK players whatever the size of a team.
    """
    chunk = F.floor(F.col("player_id") / LINEUP_CHUNK).alias("chunk")
    entry = F.struct(
        F.struct(F.col("player_id").alias("id"), F.col("player_name").alias("name")).alias("player"),
        _ref("position_name").alias("position"),
        F.col("jersey_number").alias("jersey_number"),
    )
    grouped = flat.groupBy("match_id", "team_id", "team_name", *extra, chunk).agg(
        F.array_sort(F.collect_set(entry)).alias("lineup")
    )
    return grouped.select(
        *_shape(
            {
                "id": F.concat_ws(
                    "-",
                    F.lit("xi"),
                    F.col("match_id").cast("string"),
                    F.col("team_id").cast("string"),
                    F.col("chunk").cast("string"),
                ),
                "index": F.lit(0),
                "type": F.struct(
                    F.lit(None).cast("bigint").alias("id"), F.lit("Starting XI").alias("name")
                ),
                "team": _ref("team_name", "team_id"),
                "minute": F.lit(0),
                "second": F.lit(0),
                "tactics": F.struct(
                    F.lit(None).cast("bigint").alias("formation"), F.col("lineup").alias("lineup")
                ),
                "match_id": F.col("match_id"),
            }
        ),
        *extra,
    )


SEASON_COLUMNS = ["competition_id", "season_id"]


def match_events(events: DataFrame, with_season: bool = False) -> DataFrame:
    """Nested match events (EVENT_SCHEMA) derived from a driver ``events`` frame.

    With ``with_season`` the competition and season ids are added as plain
    columns (the landing partition columns).
    """
    flat = flat_match_events(events).withColumns(
        {c: F.col(c).cast("bigint") for c in SEASON_COLUMNS}
    )
    extra = SEASON_COLUMNS if with_season else []
    players = flat.selectExpr(*_player_event_sql(), *extra)
    return players.unionByName(_lineup_events(flat, extra))


def matches_from_events(events: DataFrame) -> DataFrame:
    """Match documents (MATCH_SCHEMA) from nested events with season columns.

    Home team ``900+2p``, away ``901+2p`` with ``p = (match_id-3895000) div 10``;
    each score is that team's goals in the match. One aggregation over the
    events' match, team, type and shot outcome columns.
    """
    p = F.floor((F.col("match_id") - 3895000) / 10)
    home = (900 + 2 * p).cast("bigint")
    away = (901 + 2 * p).cast("bigint")
    goal = (F.col("type.name") == "Shot") & (F.col("shot.outcome.name") == "Goal")
    agg = events.groupBy("match_id", *SEASON_COLUMNS).agg(
        F.count_if(goal & (F.col("team.id") == home)).alias("home_score"),
        F.count_if(goal & (F.col("team.id") == away)).alias("away_score"),
    )
    return agg.select(
        F.col("match_id").cast("bigint").alias("match_id"),
        F.struct(
            F.col("competition_id").cast("bigint").alias("competition_id"),
            F.concat(F.lit("Competition "), F.col("competition_id").cast("string")).alias(
                "competition_name"
            ),
        ).alias("competition"),
        F.struct(
            F.col("season_id").cast("bigint").alias("season_id"),
            F.concat(F.lit("Season "), F.col("season_id").cast("string")).alias("season_name"),
        ).alias("season"),
        F.struct(
            home.alias("home_team_id"),
            F.concat(F.lit("Team "), home.cast("string")).alias("home_team_name"),
        ).alias("home_team"),
        F.struct(
            away.alias("away_team_id"),
            F.concat(F.lit("Team "), away.cast("string")).alias("away_team_name"),
        ).alias("away_team"),
        F.col("home_score"),
        F.col("away_score"),
    )


def competitions_from_matches(matches: DataFrame) -> DataFrame:
    """Competition rows (COMPETITION_SCHEMA): one per competition and season."""
    return (
        matches.select(
            F.col("competition.competition_id").alias("competition_id"),
            F.col("season.season_id").alias("season_id"),
            F.col("competition.competition_name").alias("competition_name"),
            F.concat(
                F.lit("Country "), F.col("competition.competition_id").cast("string")
            ).alias("country_name"),
            F.col("season.season_name").alias("season_name"),
        )
        .distinct()
    )


def read_driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# Bump when the derivation changes in a way FLAT_COLUMNS, PLAYER_EVENT_SQL and
# EVENT_SCHEMA do not show (e.g. the line-up packing).
LANDING_VERSION = 7

# A session may set this to land into a folder of its own (the benchmark does,
# to time a fresh landing inside the shared checkpoint folder).
LANDING_TAG_CONF = "touchline.landing.tag"


def _fingerprint(spark: SparkSession, path: str) -> str:
    """Every file of the source (path, length, modification time; subfolders
    included) and the derivation itself, so a changed source or a changed
    derivation is landed again instead of being served stale."""
    p, fs = _fs(spark, path)
    digest = hashlib.sha1()
    files = []
    listing = fs.listFiles(p, True)
    while listing.hasNext():
        f = listing.next()
        files.append(f"{f.getPath().toUri()}|{f.getLen()}|{f.getModificationTime()}")
    for key in [
        *sorted(files),
        repr(FLAT_COLUMNS),
        repr(PLAYER_EVENT_SQL),
        EVENT_SCHEMA.json(),
        str(LINEUP_CHUNK),
        str(LANDING_VERSION),
        spark.conf.get(LANDING_TAG_CONF, ""),
    ]:
        digest.update(key.encode() + b"\n")
    return digest.hexdigest()[:16]


_LANDING_LOCK = threading.Lock()


def landed_paths(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(events, matches) Parquet paths of ``sf_dir``'s derived tables.

    The source is fingerprinted on every call. Its tables live under the shared
    checkpoint folder in a folder named by source and fingerprint; each landing
    writes a version folder of its own there and, once both tables are complete,
    a marker that names it. Only marked versions are read: a half-written
    landing never is, and it cannot harm a complete one. Of two concurrent
    landings either may be read, they hold the same rows. Folders of older
    fingerprints of the same source are removed after a landing.
    """
    src = f"{sf_dir.rstrip('/')}/events.parquet"
    p, fs = _fs(spark, src)
    name = hashlib.sha1(f"{fs.makeQualified(p).toUri()}|{spark.conf.get(LANDING_TAG_CONF, '')}".encode()).hexdigest()[:12]
    home = f"{checkpoint_dir(spark).rstrip('/')}/derived-{name}"
    root = f"{home}/{_fingerprint(spark, src)}"
    with _LANDING_LOCK:
        version = _published(spark, root)
        if version is None:
            version = uuid.uuid4().hex
            _land_version(spark, sf_dir, f"{root}/{version}")
            p_marker, fs = _fs(spark, f"{root}/_published/{version}")
            fs.create(p_marker, False).close()
            _remove_others(spark, home, root)
    return f"{root}/{version}/events", f"{root}/{version}/matches"


def _published(spark: SparkSession, root: str) -> str | None:
    """The version that a completion marker names, if there is one."""
    p, fs = _fs(spark, f"{root}/_published")
    if not fs.exists(p):
        return None
    return min((f.getPath().getName() for f in fs.listStatus(p)), default=None)


def _remove_others(spark: SparkSession, home: str, root: str) -> None:
    p, fs = _fs(spark, home)
    for f in fs.listStatus(p):
        if f.getPath().getName() != root.rpartition("/")[2]:
            fs.delete(f.getPath(), True)


def _land_version(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land the derived events and matches, as the ingest job would.

    Events are written by the same writer as real match documents: partitioned
    by competition season and sorted by match. Matches are then one aggregation
    over the landed events.
    """
    write_events(match_events(read_driver_events(spark, sf_dir), with_season=True), f"{path}/events")
    landed = spark.read.schema(LANDED_EVENTS_SCHEMA).parquet(f"{path}/events")
    write_index(landed, index_path(f"{path}/events"))
    land_table(matches_from_events(landed), f"{path}/matches")


LANDED_EVENTS_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField(c, T.LongType()) for c in SEASON_COLUMNS]
)

def load_match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested match events of ``sf_dir`` (landed once, then read as Parquet)."""
    return spark.read.schema(LANDED_EVENTS_SCHEMA).parquet(landed_paths(spark, sf_dir)[0])


def load_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match documents of ``sf_dir`` (landed once, then read as Parquet)."""
    return spark.read.schema(MATCH_SCHEMA).parquet(landed_paths(spark, sf_dir)[1])


def load_match_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In which partition each match of ``sf_dir`` lies."""
    return read_index(spark, landed_paths(spark, sf_dir)[0])
