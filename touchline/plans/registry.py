"""Registered queries: one per operator of the inventory, over whole tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
match events derived from the driver's ``events`` table (FIXTURES.md §3). The
derivation is landed as nested Parquet once per source (under the checkpoint
folder) and every query reads that table, as statistics read landed match
documents in production. Point arrays are returned as x / y columns so an SQL
engine can compare them.

Queries return each table in its writer form, without the presentation sort
the named-statistic API (``plans.catalog``) applies: a global sort costs a
sampling job and a range shuffle, and a table written to Parquet or compared
as a set has no use for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import measures as M
from touchline.functions.columns import coord
from touchline.operators import aggregations as A
from touchline.operators import projections as P
from touchline.operators import spatial as S
from touchline.operators import team as TM
from touchline.plans import catalog
from touchline.plans import documents as DOC
from touchline.plans.documents import flat
from touchline.sources import derived as D
from touchline.sources.landing import json_rows
from touchline.sources.season import align_union, season_events

Query = Callable[[SparkSession, str], DataFrame]

# The team of the source client's examples, and one player id
# present at every scale of the test data, for the player filter overloads.
TEAM_ID = 904
TEAM_NAME = "Team 904"
PLAYER_ID = 7
SEASON = (9, 281)
TOP_N = 5
# A match of that season and one of its teams.
MATCH_ID = 3895000
SEASON_TEAM = 900
# The season after it, and the last digit of the matches that a list moves there.
LATER_SEASON = (9, 282)
RELISTED = 1


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.load_match_events(spark, sf_dir)


def _xy(df: DataFrame, col: str, prefix: str = "", dims: int = 2) -> DataFrame:
    names = ["x", "y", "z"][:dims]
    cols = [coord(col, i).alias(f"{prefix}{n}") for i, n in enumerate(names)]
    keep = [c for c in df.columns if c != col]
    idx = df.columns.index(col)
    return df.select(*keep[:idx], *cols, *keep[idx:])


def _pass_locations(df: DataFrame) -> DataFrame:
    return _xy(_xy(df, "start_location", "start_"), "end_location", "end_")


def _shot_locations(df: DataFrame) -> DataFrame:
    return _xy(_xy(df, "start_location", "start_"), "end_location", "end_", dims=3)


def _positions(df: DataFrame) -> DataFrame:
    return _xy(df, "location")


def _season_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(season_events(_ev(spark, sf_dir), D.load_matches(spark, sf_dir), *SEASON, index=D.load_match_index(spark, sf_dir)))


def _season_events_relisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, S6 after the list moved matches to the season: they are found where they were landed."""
    season = F.col("season")
    moved = F.struct(F.lit(LATER_SEASON[1]).cast("bigint").alias("season_id"), season["season_name"].alias("season_name"))
    matches = D.load_matches(spark, sf_dir).withColumn("season", F.when(F.col("match_id") % 10 == RELISTED, moved).otherwise(season))
    return flat(season_events(_ev(spark, sf_dir), matches, *LATER_SEASON, index=D.load_match_index(spark, sf_dir)))


def _season_events_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, S6 on events that don't carry their season."""
    events = _ev(spark, sf_dir).drop("competition_id", "season_id")
    return flat(season_events(events, D.load_matches(spark, sf_dir), *SEASON))


def _align_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: frames of three kinds of events, each without the others' columns."""
    events = _ev(spark, sf_dir)
    of = lambda kind, **cols: events.filter(F.col("type.name") == kind).select("match_id", "id", *[F.col(c).alias(n) for n, c in cols.items()])
    return align_union([
        of("Pass", pass_outcome="pass.outcome.name"), of("Shot", shot_outcome="shot.outcome.name"), of("Pressure", player_name="player.name")
    ])


def _json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: rows as JSON objects; the line-ups have no player and leave it out."""
    return json_rows(_ev(spark, sf_dir).select("match_id", "id", F.col("player.name").alias("player_name")))


def _filled_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: shooters beside fouled players, zero where a player is only one of them."""
    events = _ev(spark, sf_dir)
    left = A.shots(events, sort=False).select(*M.KEYS_TPPT, "total_shots", "goal")
    right = A.fouls_won(events, sort=False).select(*M.KEYS_TPPT, "total_fouls_won")
    return TM.filled_outer_join(list(M.KEYS_TPPT), left, right)


def _season_team(name: str, **team) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return catalog.season_team_stat(_ev(spark, sf_dir), D.load_matches(spark, sf_dir), *SEASON, name, index=D.load_match_index(spark, sf_dir), **team)

    return q


def _entry_points() -> dict[str, Query]:
    """The five entry points of the source API."""
    competitions = lambda spark, sf_dir: D.competitions_from_matches(D.load_matches(spark, sf_dir))
    return {
        "entry_competitions": lambda spark, sf_dir: catalog.competitions(competitions(spark, sf_dir)),
        "entry_matches": lambda spark, sf_dir: catalog.matches(D.load_matches(spark, sf_dir), *SEASON),
        "entry_match_all": lambda spark, sf_dir: DOC.leaves(catalog.match_stat(_ev(spark, sf_dir), MATCH_ID, "all")),
        "entry_match_stat": lambda spark, sf_dir: catalog.match_stat(_ev(spark, sf_dir), MATCH_ID, "pass_acc"),
        "entry_season_stat": lambda spark, sf_dir: catalog.season_stat(_ev(spark, sf_dir), D.load_matches(spark, sf_dir), *SEASON, "shot", index=D.load_match_index(spark, sf_dir)),
        "entry_season_team_all": _season_team("all", team_id=SEASON_TEAM),
        "entry_season_team_foul": _season_team("foul", team_id=SEASON_TEAM),
        "entry_season_team_pass": _season_team("pass", team_name=f"Team {SEASON_TEAM}"),
        "entry_season_team_players": _season_team("players", team_id=SEASON_TEAM),
        "entry_season_team_default": _season_team("players"),
    }


def _heatmap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.heatmap_counts(P.player_positions(_ev(spark, sf_dir)))


def _heatmap_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.heatmap(P.player_positions(_ev(spark, sf_dir)))


def _shot_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shot_map(P.shot_locations(_ev(spark, sf_dir)))


def _shot_map_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shot_map_bounds(S.shot_map(P.shot_locations(_ev(spark, sf_dir))))


def _top_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = A.exact_passes(_ev(spark, sf_dir), sort=False)
    top = S.top_players(table, "pass_accuracy", TOP_N, partition_by=("team_id",))
    return top.select(
        "team_name", "team_id", "player_name", "player_id", "total_passes", "pass_accuracy", "rank"
    )


def _top_players_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = A.exact_passes(_ev(spark, sf_dir), sort=False)
    top = S.top_players(table, "pass_accuracy", TOP_N)
    return top.select(
        "team_name", "team_id", "player_name", "player_id", "total_passes", "pass_accuracy"
    )


def _team_complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.team_complete_rows(A.time_on_ball(_ev(spark, sf_dir), sort=False), TEAM_ID)


def _with_events(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_ev(spark, sf_dir))


Wrap = Callable[[DataFrame], DataFrame]
UNSORTED = {"sort": False}

# Player statistics with a player-filter overload: (query key stem, function,
# its extra arguments, wrapper turning point arrays into columns). Row-level
# statistics have no sort to switch off.
PLAYER_STATS: list[tuple[str, Callable[..., DataFrame], dict, Wrap | None]] = [
    ("pass_locations", P.pass_locations, {}, _pass_locations),
    ("pass_accuracy", A.pass_accuracy, UNSORTED, None),
    ("exact_passes", A.exact_passes, UNSORTED, None),
    ("shots", A.shots, UNSORTED, None),
    ("shot_locations", P.shot_locations, {}, _shot_locations),
    ("time_on_ball", A.time_on_ball, UNSORTED, None),
    ("dribbles", A.dribbles, UNSORTED, None),
    ("ball_recoveries", A.ball_recoveries, UNSORTED, None),
    ("blocks", A.blocks, UNSORTED, None),
    ("fouls_committed", A.fouls_committed, UNSORTED, None),
    ("fouls_won", A.fouls_won, UNSORTED, None),
    ("pressures", P.pressures, {}, _positions),
    ("player_positions", P.player_positions, {}, _positions),
]


def _player_query(fn, kw: dict, wrap: Wrap | None, player_id: int | None) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(_ev(spark, sf_dir), player_id=player_id, **kw)
        return wrap(df) if wrap else df

    return q


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for key, fn, kw, wrap in PLAYER_STATS:
        out[key] = _player_query(fn, kw, wrap, None)
    out["substitutions"] = _with_events(lambda ev: P.substitutions(ev, sort=False))
    out["lineup"] = _with_events(lambda ev: A.lineup(ev, sort=False))
    out["team_players"] = _with_events(lambda ev: TM.team_players(ev, TEAM_NAME))
    out["team_players_by_id"] = _with_events(lambda ev: TM.team_players_by_id(ev, TEAM_ID))
    out["team_exact_passes"] = _with_events(
        lambda ev: TM.team_exact_passes(ev, team_id=TEAM_ID, sort=False)
    )
    out["team_exact_passes_by_name"] = _with_events(
        lambda ev: TM.team_exact_passes(ev, team_name=TEAM_NAME, sort=False)
    )
    out["team_fouls"] = _with_events(lambda ev: TM.team_fouls(ev, team_id=TEAM_ID, sort=False))
    out["team_fouls_by_name"] = _with_events(
        lambda ev: TM.team_fouls(ev, team_name=TEAM_NAME, sort=False)
    )
    out["all_player_stats"] = _with_events(lambda ev: TM.all_player_stats(ev, sort=False))
    out["team_match_stats"] = _with_events(
        lambda ev: TM.team_match_stats(ev, team_id=TEAM_ID, sort=False)
    )
    out["team_match_stats_by_name"] = _with_events(
        lambda ev: TM.team_match_stats(ev, team_name=TEAM_NAME, sort=False)
    )
    for key, fn, kw, wrap in PLAYER_STATS:
        out[f"{key}_player"] = _player_query(fn, kw, wrap, PLAYER_ID)
    out["competitions"] = lambda spark, sf_dir: P.competitions(
        D.competitions_from_matches(D.load_matches(spark, sf_dir))
    )
    out["matches"] = lambda spark, sf_dir: P.matches(D.load_matches(spark, sf_dir))
    out["season_events"] = _season_events
    out["pass_vectors"] = _with_events(lambda ev: S.pass_vectors(P.pass_locations(ev)))
    out["heatmap_counts"] = _heatmap_counts
    out["heatmap_smooth"] = _heatmap_smooth
    out["shot_map"] = _shot_map
    out["shot_map_bounds"] = _shot_map_bounds
    out["top_players"] = _top_players
    out["top_players_overall"] = _top_players_overall
    out["team_complete_rows"] = _team_complete_rows
    out["event_documents"] = DOC.event_documents
    out["event_array_document"] = DOC.event_array_document
    out["match_documents"] = DOC.match_documents
    out["competition_documents"] = DOC.competition_documents
    out["document_failures"] = DOC.document_failures
    out["drift_union"] = DOC.drift_union
    out["blocks_by_schema"] = DOC.blocks_by_schema
    out["season_events_relisted"] = _season_events_relisted
    out["season_events_semi_join"] = _season_events_semi_join
    out["align_union"] = _align_union
    out["json_rows"] = _json_rows
    out["filled_outer_join"] = _filled_outer_join
    return out | _entry_points()
