"""The named-statistic surface: statistic names to DataFrame functions, and
the source API's five entry points (competitions, matches, one match, a
season, a season's team) as functions over DataFrames.

``stat(name, events, player_id)`` serves the per-match and per-season
statistics, ``team_stat(name, events, team_id, team_name)`` the team tables.
Each returns a lazy DataFrame; nothing is collected. A player id of None (or
-1, the source default) means every player.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import aggregations as A
from touchline.operators import projections as P
from touchline.operators import team as TM
from touchline.sources.season import season_events

PlayerFn = Callable[..., DataFrame]


def _raw(events: DataFrame, player_id: int | None = None) -> DataFrame:
    """K2: the events unchanged (the player id is ignored, as in the source)."""
    return events


def _lineup(events: DataFrame, player_id: int | None = None) -> DataFrame:
    return A.lineup(events)


def _subs(events: DataFrame, player_id: int | None = None) -> DataFrame:
    return P.substitutions(events)


# The statistic names of the source API.
STATS: dict[str, PlayerFn] = {
    "all": _raw,
    "players": _lineup,
    "subs": _subs,
    "pass_acc": A.pass_accuracy,
    "pass_info": A.exact_passes,
    "pass_localizations": P.pass_locations,
    "shot": A.shots,
    "shot_localizations": P.shot_locations,
    "possesion": A.time_on_ball,
    "dribble": A.dribbles,
    "recovery": A.ball_recoveries,
    "block": A.blocks,
    "fouls_commit": A.fouls_committed,
    "fouls_won": A.fouls_won,
    "position": P.player_positions,
    "pressure": P.pressures,
}
STATS["possession"] = A.time_on_ball

TEAM_STATS = ("all", "foul", "pass", "players")


# Statistics whose columns depend on the data in the source.
SHAPED = {"block", "fouls_commit", "fouls_won"}


def stat(
    name: str, events: DataFrame, player_id: int | None = None, source_shape: bool = False
) -> DataFrame:
    """A named statistic over a match's or a season's events.

    ``source_shape`` drops the block and foul kinds that never occur, as the
    source does; by default those tables keep every column.
    """
    if name not in STATS:
        raise ValueError(f"unknown stat: {name}")
    if player_id is not None and player_id < 0:
        player_id = None
    if source_shape and name in SHAPED:
        return STATS[name](events, player_id=player_id, drop_absent=True)
    return STATS[name](events, player_id=player_id)


def team_stat(
    name: str, events: DataFrame, team_id: int | None = None, team_name: str | None = None
) -> DataFrame:
    """A named team table of one team: a non-empty name wins over the id, and
    with neither the id is 0, which no team has, so the table is empty."""
    if name not in TEAM_STATS:
        raise ValueError(f"unknown team stat: {name}")
    team: dict = {"team_name": team_name} if team_name else {"team_id": team_id or 0}
    if name == "players":
        return TM.team_players(events, **team) if team_name else TM.team_players_by_id(events, **team)
    tables = {"all": TM.team_match_stats, "foul": TM.team_fouls, "pass": TM.team_exact_passes}
    return tables[name](events, **team)


# --- the five entry points of the source API, as functions over DataFrames ---


def competitions(competitions_df: DataFrame, all: bool = False) -> DataFrame:  # noqa: A002
    """Competition list (P1), or the raw documents with ``all``."""
    return competitions_df if all else P.competitions(competitions_df)


def matches(
    matches_df: DataFrame, competition_id: int, season_id: int, all: bool = False  # noqa: A002
) -> DataFrame:
    """One competition season's matches (P2), or the raw documents with ``all``."""
    season = matches_df.filter(
        (F.col("competition.competition_id") == F.lit(competition_id))
        & (F.col("season.season_id") == F.lit(season_id))
    )
    return season if all else P.matches(season)


def match_stat(
    events: DataFrame,
    match_id: int,
    name: str,
    player_id: int | None = None,
    source_shape: bool = False,
) -> DataFrame:
    """A named statistic of one match. On landed events (sorted by match
    within each file) the match filter skips row groups by their statistics."""
    one_match = events.filter(F.col("match_id") == F.lit(match_id))
    return stat(name, one_match, player_id, source_shape)


def season_stat(
    events: DataFrame,
    matches_df: DataFrame,
    competition_id: int,
    season_id: int,
    name: str,
    player_id: int | None = None,
    source_shape: bool = False,
    index: DataFrame | None = None,
) -> DataFrame:
    """A named statistic of one competition season; with the ``index`` of landed
    events only the partitions of its matches are read."""
    season = season_events(events, matches_df, competition_id, season_id, index)
    return stat(name, season, player_id, source_shape)


def season_team_stat(
    events: DataFrame,
    matches_df: DataFrame,
    competition_id: int,
    season_id: int,
    name: str,
    team_id: int | None = None,
    team_name: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """A named team table of one competition season."""
    season = season_events(events, matches_df, competition_id, season_id, index)
    return team_stat(name, season, team_id=team_id, team_name=team_name)
