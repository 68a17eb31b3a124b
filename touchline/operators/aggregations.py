"""Per-player aggregated statistics (A1-A10).

Each statistic is one ``groupBy(player keys).agg(...)`` over the events of
its type. Spark plans it as a partial aggregation before the shuffle and a
final one after, so a player (or team) holding a large share of the events
costs one pre-aggregated row per map task, never a hot reducer.

Filters for a player or team are applied to the events, before the
aggregation, so they reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import measures as M
from touchline.functions.columns import (
    PLAYER_KEYS,
    count_if_sql,
    minutes_rounded_sql,
    pct_sql,
    player_keys,
    type_is,
)


def scope(
    events: DataFrame,
    player_id: int | None = None,
    team_id: int | None = None,
    team_name: str | None = None,
) -> DataFrame:
    """Restrict events to one player and/or team (None = no restriction); a
    team name wins over a team id."""
    if player_id is not None:
        events = events.filter(F.col("player.id") == F.lit(player_id))
    if team_name is not None:
        events = events.filter(F.col("team.name") == F.lit(team_name))
    elif team_id is not None:
        events = events.filter(F.col("team.id") == F.lit(team_id))
    return events


def _and(a: str | None, b: str | None) -> str | None:
    if a is None:
        return b
    if b is None:
        return a
    return f"({a}) AND ({b})"


def stat_aggregates_sql(stat: M.Stat, within: str | None = None) -> list[str]:
    """Aggregate expressions of ``stat`` as ``expr AS name``; ``within`` (SQL)
    restricts them to some rows."""
    aggs = [f"{count_if_sql(_and(within, cond))} AS {name}" for name, cond in stat.counts]
    for name, value in stat.minutes:
        col = value if within is None else f"CASE WHEN {within} THEN {value} END"
        aggs.append(f"{minutes_rounded_sql(col)} AS {name}")
    return aggs


def stat_aggregates(stat: M.Stat, within: str | None = None) -> list[Column]:
    """Aggregate Columns of ``stat`` (one parsed expression each)."""
    return [F.expr(a) for a in stat_aggregates_sql(stat, within)]


def stat_ratios_sql(stat: M.Stat) -> dict[str, str]:
    return {r.name: pct_sql(r.part, r.whole, r.scale) for r in stat.ratios}


def _finish(table: DataFrame, columns: list[str], computed: dict[str, str]) -> DataFrame:
    """One projection: each output column as is, or computed from SQL."""
    return table.selectExpr(
        *[f"{computed[c]} AS {c}" if c in computed else f"`{c}`" for c in columns]
    )


def type_is_sql(name: str) -> str:
    return f"type.name = {M.sql_str(name)}"


def order_stat(df: DataFrame, desc: str, first: str = "team_name") -> DataFrame:
    """The source ordering (team, then the headline measure, descending) with
    all player keys as tie-break so the order is total."""
    ties = [k for k in ("player_id", "team_id", "team_name", "player_name") if k in df.columns and k != first]
    return df.orderBy(F.col(first), F.col(desc).desc(), *ties)


def player_stat(
    events: DataFrame,
    stat: M.Stat,
    player_id: int | None = None,
    team_id: int | None = None,
    team_name: str | None = None,
    sort: bool = True,
) -> DataFrame:
    """One statistic table: filter to the type, aggregate, add ratios."""
    df = scope(events, player_id, team_id, team_name).filter(type_is(stat.event_type))
    out = df.groupBy(*player_keys()).agg(*stat_aggregates(stat))
    out = _finish(out, stat.columns(), stat_ratios_sql(stat))
    return order_stat(out, stat.sort_desc) if sort else out


def drop_absent(table: DataFrame, stat: M.Stat, always: tuple[str, ...]) -> DataFrame:
    """The source's data-dependent shape: drop every optional measure (and its
    ratio) that is 0 for all rows. One aggregate job over the (per-player)
    table decides; the columns in ``always`` are kept regardless."""
    ratio_of = {r.part: r.name for r in stat.ratios}
    optional = [n for n, _ in stat.counts if n not in always]
    if not optional:
        return table
    table = table.persist(StorageLevel.MEMORY_AND_DISK)  # per player, not per event
    row = table.agg(*[F.max(F.col(c)).alias(c) for c in optional]).first()
    absent = [c for c in optional if row is None or not row[c]]
    return table.drop(*absent, *[ratio_of[c] for c in absent if c in ratio_of])


def pass_accuracy(events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """A2."""
    return player_stat(events, M.pass_accuracy(), player_id=player_id, **kw)


def exact_passes(events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """A3, with team and player ids kept so callers can filter on them."""
    return player_stat(events, M.exact_passes(), player_id=player_id, **kw)


def shots(events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """A4."""
    return player_stat(events, M.shots(), player_id=player_id, **kw)


def time_on_ball(events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """A5."""
    return player_stat(events, M.time_on_ball(), player_id=player_id, **kw)


def dribbles(events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """A6."""
    return player_stat(events, M.dribbles(), player_id=player_id, **kw)


def ball_recoveries(events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """A7."""
    return player_stat(events, M.ball_recoveries(), player_id=player_id, **kw)


def nested_field_exists(schema: T.StructType, parent: str, nested: str) -> bool:
    """H1: whether ``parent`` is an object with the field ``nested``, itself or in an object inside it."""
    kind = next((f.dataType for f in schema.fields if f.name == parent), None)
    if not isinstance(kind, T.StructType):
        return False
    inner = [f.dataType for f in kind.fields if isinstance(f.dataType, T.StructType)]
    return nested in kind.names or any(nested in t.names for t in inner)


_FLAG = re.compile(r"(\w+)\.(\w+)(?:\.\w+)* (?:IS NOT NULL|=)")
_PLAIN = re.compile(r"(\w+) IS NULL")


def within_schema(stat: M.Stat, schema: T.StructType) -> M.Stat:
    """``stat`` without the counts (and their ratios) of fields that ``schema`` doesn't have.

    Decided from the schema alone, without a job. An event whose detail object is in
    no document has none, so it counts as a standard one.
    """
    counts = []
    for name, condition in stat.counts:
        flag, plain = _FLAG.match(condition or ""), _PLAIN.match(condition or "")
        if flag and not nested_field_exists(schema, flag[1], flag[2]):
            continue
        counts.append((name, "true" if plain and plain[1] not in schema.names else condition))
    gone = {n for n, _ in stat.counts} - {n for n, _ in counts}
    ratios = tuple(r for r in stat.ratios if r.part not in gone)
    gone |= {r.name for r in stat.ratios} - {r.name for r in ratios}
    return dataclasses.replace(stat, counts=tuple(counts), ratios=ratios, measure_columns=tuple(c for c in stat.measure_columns if c not in gone))


def _fixed_or_trimmed(events, stat, always, player_id, trim, by_schema, kw) -> DataFrame:
    if by_schema:
        stat = within_schema(stat, events.schema)
    table = player_stat(events, stat, player_id=player_id, **kw)
    return drop_absent(table, stat, always) if trim else table


def blocks(
    events: DataFrame, player_id: int | None = None, drop_absent: bool = False, by_schema: bool = False, **kw
) -> DataFrame:
    """A8, fixed columns (0 where a kind never occurs); ``drop_absent`` drops
    kinds that never occur, as the source does; ``by_schema`` leaves out kinds
    whose field ``events`` doesn't have, as documents with an inferred schema do."""
    return _fixed_or_trimmed(
        events, M.blocks(), ("total_blocks", "standard_blocks"), player_id, drop_absent, by_schema, kw
    )


def fouls_committed(
    events: DataFrame, player_id: int | None = None, drop_absent: bool = False, by_schema: bool = False, **kw
) -> DataFrame:
    """A9, fixed columns (0 where a kind never occurs); ``drop_absent`` drops
    kinds that never occur, as the source does; ``by_schema`` leaves out kinds
    whose field ``events`` doesn't have, as documents with an inferred schema do."""
    return _fixed_or_trimmed(
        events,
        M.fouls_committed(),
        ("total_fouls_committed", "standard_fouls"),
        player_id,
        drop_absent,
        by_schema,
        kw,
    )


def fouls_won(
    events: DataFrame, player_id: int | None = None, drop_absent: bool = False, by_schema: bool = False, **kw
) -> DataFrame:
    """A10, fixed columns (0 where a kind never occurs); ``drop_absent`` drops
    kinds that never occur, as the source does; ``by_schema`` leaves out kinds
    whose field ``events`` doesn't have, as documents with an inferred schema do."""
    return _fixed_or_trimmed(
        events, M.fouls_won(), ("total_fouls_won", "standard_fouls"), player_id, drop_absent, by_schema, kw
    )


def combined_stats(
    events: DataFrame,
    stats: Sequence[M.Stat],
    team_id: int | None = None,
    team_name: str | None = None,
) -> DataFrame:
    """Several statistics in ONE aggregation over one scan.

    Each measure is restricted to its statistic's event type inside the
    aggregate, so a player missing a type gets 0 counts, 0.0 ratios and 0.0
    minutes: the values a full outer join of the separate tables gives after
    zero filling. Rows without a player are dropped first (a join never
    matches null keys).
    """
    types = sorted({s.event_type for s in stats})
    df = scope(events, team_id=team_id, team_name=team_name).filter(
        F.col("type.name").isin(types) & F.col("player.id").isNotNull()
    )
    aggs: list[Column] = []
    for s in stats:
        aggs += stat_aggregates(s, within=type_is_sql(s.event_type))
    out = df.groupBy(*player_keys()).agg(*aggs)
    computed: dict[str, str] = {}
    for s in stats:
        computed.update(stat_ratios_sql(s))
        for name, _ in s.minutes:
            computed[name] = f"coalesce({name}, 0.0)"
    columns = list(PLAYER_KEYS) + [c for s in stats for c in _measure_names(s)]
    return _finish(out, columns, computed)


def _measure_names(stat: M.Stat) -> list[str]:
    """Every count, minute and ratio column of a statistic, in output order
    where the statistic lists them, then any others."""
    names = list(stat.measure_columns)
    extra = [n for n, _ in stat.counts] + [n for n, _ in stat.minutes] + [r.name for r in stat.ratios]
    return names + [n for n in extra if n not in names]


def lineup(
    events: DataFrame,
    team_id: int | None = None,
    team_name: str | None = None,
    sort: bool = True,
) -> DataFrame:
    """A1: players from the line-ups with jersey number and all positions played.

    Positions are deduplicated map-side (``collect_set``) before the shuffle,
    so a group holds at most one entry per distinct position however many
    line-ups name the player.
    """
    entries = scope(events, team_id=team_id, team_name=team_name).select(
        F.col("team.name").alias("team_name"),
        F.col("team.id").alias("team_id"),
        F.explode("tactics.lineup").alias("e"),
    ).select(
        "team_name",
        "team_id",
        F.col("e.player.name").alias("player_name"),
        F.col("e.jersey_number").alias("player_number"),
        F.col("e.player.id").alias("player_id"),
        F.col("e.position.name").alias("position"),
    )
    out = entries.groupBy(
        "team_name", "team_id", "player_name", "player_number", "player_id"
    ).agg(
        F.array_join(F.array_sort(F.collect_set("position")), ", ").alias("player_positions")
    )
    if sort:
        out = out.orderBy("team_name", "player_number", "player_id")
    return out
