"""Team statistics (T1-T5) and the outer-join-and-fill helper (H2).

The all-player table is one aggregation over one scan (every measure of
passes, shots, dribbles, recoveries, blocks and carry time at once) and a
single full outer join with the line-up table, instead of seven sub-plans
and six joins. Both join sides are pre-aggregated before any shuffle: the
measures side arrives hash-partitioned on the player keys from its own
aggregation; the line-up side (one row per player and jersey number) is
re-partitioned once. A full outer join is never broadcast; it is a sort-merge
join of two tables the size of the player list, where no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import measures as M
from touchline.functions.columns import PLAYER_KEYS
from touchline.operators import aggregations as A


def filled_outer_join(keys: list[str], left: DataFrame, right: DataFrame) -> DataFrame:
    """H2: full outer join of two tables on null-safe ``keys``, then numeric
    nulls to zero and string nulls to "", all in one projection."""
    other = right.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(other[f"_key_{k}"]) for k in keys]
    joined = left.join(other, on, "full_outer")

    def filled(name: str, value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.NumericType):
            value = F.coalesce(value, F.lit(0).cast(kind))
        elif isinstance(kind, T.StringType):
            value = F.coalesce(value, F.lit(""))
        return value.alias(name)

    key = [filled(k, F.coalesce(F.col(k), F.col(f"_key_{k}")), left.schema[k].dataType) for k in keys]
    rest = [(f.name, f.dataType) for df in (left, right) for f in df.schema if f.name not in keys]
    return joined.select(*key, *[filled(c, F.col(c), kind) for c, kind in rest])


def team_players(events: DataFrame, team_name: str) -> DataFrame:
    """Distinct names of a team's players (column ``name``)."""
    return (
        A.scope(events, team_name=team_name)
        .filter(F.col("player.name").isNotNull())
        .select(F.col("player.name").alias("name"))
        .distinct()
    )


def team_players_by_id(events: DataFrame, team_id: int) -> DataFrame:
    """Distinct (name, id) of a team's players."""
    return (
        A.scope(events, team_id=team_id)
        .filter(F.col("player.name").isNotNull())
        .select(F.col("player.name").alias("name"), F.col("player.id").alias("id"))
        .distinct()
    )


def team_exact_passes(
    events: DataFrame, team_id: int | None = None, team_name: str | None = None, sort: bool = True
) -> DataFrame:
    """The exact pass table of one team (filtered before aggregating)."""
    return A.exact_passes(events, team_id=team_id, team_name=team_name, sort=sort)


# Measures that fouls committed and fouls won both define, renamed in the
# combined team table so each name is unique.
_SHARED_FOUL_MEASURES = [
    "standard_fouls",
    "standard_foul_ratio",
    "advantage_fouls",
    "advantage_foul_ratio",
    "penalty_fouls",
    "penalty_foul_ratio",
]


def team_fouls_stats() -> tuple[M.Stat, M.Stat]:
    committed = M.renamed(M.fouls_committed(), {m: f"committed_{m}" for m in _SHARED_FOUL_MEASURES})
    won = M.renamed(M.fouls_won(), {m: f"won_{m}" for m in _SHARED_FOUL_MEASURES})
    return committed, won


def team_fouls(
    events: DataFrame, team_id: int | None = None, team_name: str | None = None, sort: bool = True
) -> DataFrame:
    """Fouls committed and won side by side for a team's players.

    One aggregation over both event types: a player with only one kind gets 0
    for the other, as zero filling after a full outer join would give.
    """
    committed, won = team_fouls_stats()
    out = A.combined_stats(events, [committed, won], team_id=team_id, team_name=team_name)
    keys = list(M.KEYS_TPPT)
    out = out.select(*keys, *committed.measure_columns, *won.measure_columns)  # column order
    if sort:
        out = out.orderBy("team_name", "player_name", "player_id", "team_id")
    return out


def season_stats() -> list[M.Stat]:
    """Statistics joined into the all-player table, in output order."""
    return [
        M.pass_accuracy(),
        M.shots(),
        M.dribbles(),
        M.ball_recoveries(),
        M.blocks(),
        M.time_on_ball(),
    ]


def all_player_stats(
    events: DataFrame, team_id: int | None = None, team_name: str | None = None, sort: bool = True
) -> DataFrame:
    """T4 (T5 with a team): line-up joined with every player measure, zero filled.

    A player listed with two jersey numbers gets one row per number; the key
    is (team, player, number).
    """
    stats = season_stats()
    measures = A.combined_stats(events, stats, team_id=team_id, team_name=team_name)
    players = A.lineup(events, team_id=team_id, team_name=team_name, sort=False)
    joined = players.join(measures, on=PLAYER_KEYS, how="full_outer")
    # Zero of the column's own type: 0 for counts, 0.0 for ratios and minutes.
    zero = {c: "0" for s in stats for c, _ in s.counts}
    zero.update({r.name: "0.0" for s in stats for r in s.ratios})
    zero.update({c: "0.0" for s in stats for c, _ in s.minutes})
    measure_cols = [c for s in stats for c in s.measure_columns]
    out = joined.selectExpr(
        *PLAYER_KEYS,
        "coalesce(player_number, cast(0 AS bigint)) AS player_number",
        "coalesce(player_positions, '') AS player_positions",
        *[f"coalesce({c}, {zero[c]}) AS {c}" for c in measure_cols],
    )
    if sort:
        out = out.orderBy("player_number", "team_name", "player_id", "team_id", "player_name", "player_positions")
    return out


def team_match_stats(
    events: DataFrame, team_id: int | None = None, team_name: str | None = None, sort: bool = True
) -> DataFrame:
    """T5: the all-player table of one team; a team name wins over an id."""
    if team_name:
        return all_player_stats(events, team_name=team_name, sort=sort)
    return all_player_stats(events, team_id=team_id, sort=sort)
