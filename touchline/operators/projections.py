"""Row-level statistics (P1-P7): filters and projections, no shuffle.

Each keeps one output row per input event (or document), so they are map-only
stages that run at the speed of the scan. Only the substitution list sorts,
as the source does; the sort is optional for writers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import mm_ss, type_is
from touchline.operators.aggregations import scope


def competitions(competitions_df: DataFrame) -> DataFrame:
    """Competition and season list."""
    return competitions_df.select(
        "competition_id", "season_id", "competition_name", "country_name", "season_name"
    )


def matches(matches_df: DataFrame) -> DataFrame:
    """One row per match with both teams and the score."""
    return matches_df.select(
        "match_id",
        F.col("home_team.home_team_id").alias("home_team_id"),
        F.col("home_team.home_team_name").alias("home_team_name"),
        F.col("away_team.away_team_id").alias("away_team_id"),
        F.col("away_team.away_team_name").alias("away_team_name"),
        "home_score",
        "away_score",
    )


def pass_locations(events: DataFrame, player_id: int | None = None) -> DataFrame:
    """Start, end and outcome of every pass; no outcome = 'Completed'."""
    return scope(events, player_id).filter(type_is("Pass")).select(
        F.col("player.name").alias("player_name"),
        F.col("player.id").alias("player_id"),
        F.col("team.name").alias("team_name"),
        F.col("team.id").alias("team_id"),
        F.col("location").alias("start_location"),
        F.col("pass.end_location").alias("end_location"),
        F.coalesce(F.col("pass.outcome.name"), F.lit("Completed")).alias("outcome"),
    )


def shot_locations(events: DataFrame, player_id: int | None = None) -> DataFrame:
    """Start, end (2 or 3 long) and outcome of every shot, with a goal flag."""
    return scope(events, player_id).filter(type_is("Shot")).select(
        F.col("team.name").alias("team_name"),
        F.col("team.id").alias("team_id"),
        F.col("player.id").alias("player_id"),
        F.col("player.name").alias("player_name"),
        F.col("location").alias("start_location"),
        F.col("shot.end_location").alias("end_location"),
        F.col("shot.outcome.name").alias("outcome"),
        F.when(F.col("shot.outcome.name") == "Goal", 1).otherwise(0).alias("is_goal"),
    )


def player_positions(events: DataFrame, player_id: int | None = None) -> DataFrame:
    """P5: every located event of a known team and player."""
    return scope(events, player_id).filter(
        F.col("team.name").isNotNull()
        & F.col("player.name").isNotNull()
        & F.col("location").isNotNull()
    ).select(
        F.col("team.name").alias("team_name"),
        F.col("player.name").alias("player_name"),
        F.col("player.id").alias("player_id"),
        F.col("team.id").alias("team_id"),
        F.col("location"),
    )


def pressures(events: DataFrame, player_id: int | None = None) -> DataFrame:
    """Location of every pressure (no team columns, as in the source)."""
    return scope(events, player_id).filter(type_is("Pressure")).select(
        F.col("player.id").alias("player_id"),
        F.col("player.name").alias("player_name"),
        F.col("location"),
    )


def substitutions(events: DataFrame, sort: bool = True) -> DataFrame:
    """Substitutions with the match clock as ``mm:ss``.

    ``match_id`` is kept so a season's substitutions do not mix matches, and
    the order is by match, team and numeric time (a text sort would put
    "100:00" before "11:00").
    """
    out = events.filter(F.col("substitution").isNotNull()).select(
        "match_id",
        F.col("team.name").alias("team_name"),
        F.col("team.id").alias("team_id"),
        F.col("player.name").alias("player_out"),
        F.col("player.id").alias("player_id"),
        F.col("substitution.replacement.name").alias("player_in"),
        F.col("position.name").alias("position"),
        F.col("substitution.outcome.name").alias("substitution_reason"),
        mm_ss(F.col("minute"), F.col("second")).alias("substitution_time"),
        F.col("minute").alias("_m"),
        F.col("second").alias("_s"),
    )
    if sort:
        out = out.orderBy("match_id", "team_name", "_m", "_s", "player_id")
    return out.drop("_m", "_s")
