"""Independent DuckDB SQL for every registered query.

These read the FLAT derived columns (FIXTURES.md §3) of the ``events`` view,
not the nested events the Spark operators read, and follow the source's own
plan shape where it differs from ours: the team and all-player tables are the
separate statistics full-outer-joined and zero filled, not one aggregation.
"""

from __future__ import annotations

from touchline.plans.registry import (
    LATER_SEASON,
    MATCH_ID,
    PLAYER_ID,
    RELISTED,
    SEASON,
    SEASON_TEAM,
    TEAM_ID,
    TEAM_NAME,
    TOP_N,
)
from touchline.plans.documents import DAMAGE, LEAVES
from touchline.sources.derived import LINEUP_CHUNK, flat_match_events_sql

ME = flat_match_events_sql("events")


def _with(body: str, *ctes: tuple[str, str]) -> str:
    parts = [f"me AS ({ME})"] + [f"{name} AS ({sql})" for name, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def pct(a: str, b: str, scale: int = 0) -> str:
    return f"coalesce(round(cast({a} AS DOUBLE) / nullif({b}, 0) * 100, {scale}), 0.0)"


def _cnt(cond: str | None) -> str:
    return "count(*)" if cond is None else f"count(*) FILTER (WHERE {cond})"


KEYS = "team_name, team_id, player_name, player_id"


def _table(type_name: str, counts: list[tuple[str, str | None]], extra_where: str = "") -> str:
    cols = ",\n  ".join(f"{_cnt(c)} AS {n}" for n, c in counts)
    where = f"type_name = '{type_name}'" + (f" AND {extra_where}" if extra_where else "")
    return f"SELECT {KEYS},\n  {cols}\nFROM me WHERE {where}\nGROUP BY {KEYS}"


def _select(inner: str, cols: list[str]) -> str:
    return f"SELECT {', '.join(cols)} FROM ({inner}) AS s"


# --- A2 .. A10 as SQL over the flat columns --------------------------------

def pass_accuracy_sql(where: str = "") -> str:
    inner = _table("Pass", [("total_passes", None), ("accurate_passes", "pass_outcome IS NULL")], where)
    return _select(inner, [KEYS, "total_passes", "accurate_passes",
                           f"{pct('accurate_passes', 'total_passes')} AS pass_accuracy"])


PASS_KIND_SQL = [
    ("drop_kick", "pass_body_part = 'Drop Kick'"),
    ("head", "pass_body_part = 'Head'"),
    ("keeper_arm", "pass_body_part = 'Keeper Arm'"),
    ("left_foot", "pass_body_part = 'Left Foot'"),
    ("right_foot", "pass_body_part = 'Right Foot'"),
    ("other_body_part", "pass_body_part = 'Other'"),
    ("no_touch", "pass_body_part = 'No Touch'"),
    ("throw_in", "pass_type = 'Throw-in'"),
    ("recovery", "pass_type = 'Recovery' AND pass_body_part IS NULL"),
]


def exact_passes_sql(where: str = "") -> str:
    counts: list[tuple[str, str | None]] = [("total_passes", None), ("accurate_passes", "pass_outcome IS NULL")]
    cols = [KEYS, "accurate_passes", "total_passes", f"{pct('accurate_passes', 'total_passes')} AS pass_accuracy"]
    for kind, cond in PASS_KIND_SQL:
        acc, tot = f"accurate_{kind}_passes", f"total_{kind}_passes"
        counts += [(acc, f"pass_outcome IS NULL AND {cond}"), (tot, cond)]
        cols += [acc, tot, f"{pct(acc, tot)} AS {kind}_passes_accuracy"]
    return _select(_table("Pass", counts, where), cols)


def shots_sql(where: str = "") -> str:
    inner = _table("Shot", [
        ("total_shots", None),
        ("goal", "shot_outcome = 'Goal'"),
        ("blocked_or_saved_by_goalkeeper", "shot_outcome IN ('Saved', 'Saved off T', 'Saved to Post', 'Blocked')"),
        ("not_on_target", "shot_outcome IN ('Off T', 'Post', 'Wayward')"),
    ], where)
    return _select(inner, [KEYS, "total_shots", "goal", "blocked_or_saved_by_goalkeeper", "not_on_target",
                           f"{pct('total_shots - not_on_target', 'total_shots')} AS on_target_accuracy",
                           f"{pct('not_on_target', 'total_shots')} AS not_on_target_accuracy",
                           f"{pct('goal', 'total_shots')} AS shots_per_goal_ratio"])


def time_on_ball_sql(where: str = "") -> str:
    w = "type_name = 'Carry'" + (f" AND {where}" if where else "")
    return (f"SELECT {KEYS}, ((sum(cast(round(duration*100) AS BIGINT)) + 30) // 60) / 100 "
            f"AS total_time_with_ball FROM me WHERE {w} GROUP BY {KEYS}")


def dribbles_sql(where: str = "") -> str:
    inner = _table("Dribble", [("successful_dribbles", "dribble_outcome = 'Complete'"), ("total_dribbles", None)], where)
    return _select(inner, [KEYS, "successful_dribbles", "total_dribbles",
                           f"{pct('successful_dribbles', 'total_dribbles')} AS dribbles_win_ratio"])


def ball_recoveries_sql(where: str = "") -> str:
    inner = _table("Ball Recovery", [("successful_ball_recoveries", "recovery_failure IS NULL"),
                                      ("total_ball_recoveries", None)], where)
    return _select(inner, [KEYS, "successful_ball_recoveries", "total_ball_recoveries",
                           f"{pct('successful_ball_recoveries', 'total_ball_recoveries')} AS ball_recovery_ratio"])


BLOCK_SQL = [("deflection_blocks", "deflection_block_ratio", "block_deflection"),
             ("offensive_blocks", "offensive_block_ratio", "block_offensive"),
             ("save_blocks", "save_block_ratio", "block_save"),
             ("counterpress_blocks", "counterpress_block_ratio", "block_counterpress")]


def blocks_sql(where: str = "") -> str:
    counts: list[tuple[str, str | None]] = [("total_blocks", None), ("standard_blocks", "NOT block_present")]
    cols = [KEYS, "total_blocks", "standard_blocks", f"{pct('standard_blocks', 'total_blocks')} AS standard_block_ratio"]
    for n, r, flag in BLOCK_SQL:
        counts.append((n, f"{flag} IS NOT NULL"))
        cols += [n, f"{pct(n, 'total_blocks')} AS {r}"]
    return _select(_table("Block", counts, where), cols)


FOUL_SQL = [("six_seconds_fouls", "six_seconds_foul_ratio", "foul_type = '6 Seconds'"),
            ("backpass_pick_fouls", "backpass_pick_foul_ratio", "foul_type = 'Backpass Pick'"),
            ("dangerous_play_fouls", "dangerous_play_foul_ratio", "foul_type = 'Dangerous Play'"),
            ("dive_fouls", "dive_foul_ratio", "foul_type = 'Dive'"),
            ("fouls_out", "foul_out_ratio", "foul_type = 'Foul Out'"),
            ("handball_fouls", "handball_foul_ratio", "foul_type = 'Handball'"),
            ("counterpress_fouls", "counterpress_foul_ratio", "foul_counterpress IS NOT NULL"),
            ("offensive_fouls", "offensive_foul_ratio", "foul_offensive IS NOT NULL"),
            ("advantage_fouls", "advantage_foul_ratio", "foul_advantage IS NOT NULL"),
            ("penalty_fouls", "penalty_foul_ratio", "foul_penalty IS NOT NULL"),
            ("card_fouls", "card_foul_ratio", "foul_card IS NOT NULL")]

WON_SQL = [("defensive_fouls", "defensive_foul_ratio", "won_defensive IS NOT NULL"),
           ("advantage_fouls", "advantage_foul_ratio", "won_advantage IS NOT NULL"),
           ("penalty_fouls", "penalty_foul_ratio", "won_penalty IS NOT NULL")]


def _fouls_sql(type_name: str, total: str, present: str, spec, where: str, rename=None) -> str:
    rn = rename or (lambda s: s)
    counts: list[tuple[str, str | None]] = [(total, None), ("standard_fouls", f"NOT {present}")]
    cols = [KEYS, total, f"standard_fouls AS {rn('standard_fouls')}",
            f"{pct('standard_fouls', total, 2)} AS {rn('standard_foul_ratio')}"]
    for n, r, cond in spec:
        counts.append((n, cond))
        cols += [f"{n} AS {rn(n)}", f"{pct(n, total, 2)} AS {rn(r)}"]
    return _select(_table(type_name, counts, where), cols)


def fouls_committed_sql(where: str = "", rename=None) -> str:
    return _fouls_sql("Foul Committed", "total_fouls_committed", "foul_present", FOUL_SQL, where, rename)


def fouls_won_sql(where: str = "", rename=None) -> str:
    return _fouls_sql("Foul Won", "total_fouls_won", "won_present", WON_SQL, where, rename)


PLAYER_STAT_SQL = {
    "pass_accuracy": pass_accuracy_sql,
    "exact_passes": exact_passes_sql,
    "shots": shots_sql,
    "time_on_ball": time_on_ball_sql,
    "dribbles": dribbles_sql,
    "ball_recoveries": ball_recoveries_sql,
    "blocks": blocks_sql,
    "fouls_committed": fouls_committed_sql,
    "fouls_won": fouls_won_sql,
}

# --- row-level statistics --------------------------------------------------


def pass_locations_sql(where: str = "") -> str:
    w = "type_name = 'Pass'" + (f" AND {where}" if where else "")
    return ("SELECT player_name, player_id, team_name, team_id, location_x AS start_x, location_y AS start_y, "
            "end_x, end_y, coalesce(pass_outcome, 'Completed') AS outcome "
            f"FROM me WHERE {w}")


def shot_locations_sql(where: str = "") -> str:
    w = "type_name = 'Shot'" + (f" AND {where}" if where else "")
    return ("SELECT team_name, team_id, player_id, player_name, location_x AS start_x, location_y AS start_y, "
            "end_x, end_y, end_z, shot_outcome AS outcome, "
            "CASE WHEN shot_outcome = 'Goal' THEN 1 ELSE 0 END AS is_goal "
            f"FROM me WHERE {w}")


def pressures_sql(where: str = "") -> str:
    w = "type_name = 'Pressure'" + (f" AND {where}" if where else "")
    return f"SELECT player_id, player_name, location_x AS x, location_y AS y FROM me WHERE {w}"


def player_positions_sql(where: str = "") -> str:
    w = "team_name IS NOT NULL AND player_name IS NOT NULL AND location_x IS NOT NULL" + (
        f" AND {where}" if where else "")
    return (f"SELECT team_name, player_name, player_id, team_id, location_x AS x, location_y AS y "
            f"FROM me WHERE {w}")


ROW_STAT_SQL = {
    "pass_locations": pass_locations_sql,
    "shot_locations": shot_locations_sql,
    "pressures": pressures_sql,
    "player_positions": player_positions_sql,
}

SUBSTITUTIONS = (
    "SELECT match_id, team_name, team_id, player_name AS player_out, player_id, sub_in_name AS player_in, "
    "position_name AS position, sub_reason AS substitution_reason, "
    "(CASE WHEN minute < 10 THEN '0' ELSE '' END) || cast(minute AS VARCHAR) || ':' || "
    "lpad(cast(\"second\" AS VARCHAR), 2, '0') AS substitution_time "
    "FROM me WHERE type_name = 'Substitution'"
)

LINEUP_ROWS = ("SELECT DISTINCT match_id, team_id, team_name, player_id, player_name, jersey_number, "
               "position_name FROM me")


def lineup_sql(where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return ("SELECT team_name, team_id, player_name, jersey_number AS player_number, player_id, "
            "string_agg(DISTINCT position_name, ', ' ORDER BY position_name) AS player_positions "
            f"FROM lu {w} GROUP BY team_name, team_id, player_name, jersey_number, player_id")


# --- team tables, the source's way: separate tables, full outer joins ------

ALL_STATS_COLUMNS = {
    "pass_accuracy": ["total_passes", "accurate_passes", "pass_accuracy"],
    "shots": ["total_shots", "goal", "blocked_or_saved_by_goalkeeper", "not_on_target",
              "on_target_accuracy", "not_on_target_accuracy", "shots_per_goal_ratio"],
    "dribbles": ["successful_dribbles", "total_dribbles", "dribbles_win_ratio"],
    "ball_recoveries": ["successful_ball_recoveries", "total_ball_recoveries", "ball_recovery_ratio"],
    "blocks": ["total_blocks", "standard_blocks", "standard_block_ratio",
               "deflection_blocks", "deflection_block_ratio", "offensive_blocks", "offensive_block_ratio",
               "save_blocks", "save_block_ratio", "counterpress_blocks", "counterpress_block_ratio"],
    "time_on_ball": ["total_time_with_ball"],
}
def _zero(col: str) -> str:
    """Zero fill after an outer join: 0.0 for ratios and minutes, 0 for counts."""
    if col.endswith(("_ratio", "_accuracy")) or col == "total_time_with_ball":
        return f"coalesce({col}, 0.0) AS {col}"
    return f"coalesce({col}, 0) AS {col}"


def all_player_stats_sql(where: str = "") -> str:
    ctes = [("lu", LINEUP_ROWS), ("lineup_t", lineup_sql(where))]
    joins = "lineup_t"
    for name, cols in ALL_STATS_COLUMNS.items():
        ctes.append((f"t_{name}", PLAYER_STAT_SQL[name](where)))
        joins += f"\nFULL OUTER JOIN t_{name} USING ({KEYS})"
    measure = [_zero(c) for cols in ALL_STATS_COLUMNS.values() for c in cols]
    body = (f"SELECT {KEYS}, coalesce(player_number, 0) AS player_number, "
            f"coalesce(player_positions, '') AS player_positions, {', '.join(measure)} FROM {joins}")
    return _with(body, *ctes)


SHARED_FOUL = {"standard_fouls", "standard_foul_ratio", "advantage_fouls", "advantage_foul_ratio",
               "penalty_fouls", "penalty_foul_ratio"}


def team_fouls_sql(where: str) -> str:
    def c_rn(s):
        return f"committed_{s}" if s in SHARED_FOUL else s

    def w_rn(s):
        return f"won_{s}" if s in SHARED_FOUL else s

    committed_cols = ["total_fouls_committed", c_rn("standard_fouls"), c_rn("standard_foul_ratio")]
    for n, r, _ in FOUL_SQL:
        committed_cols += [c_rn(n), c_rn(r)]
    won_cols = ["total_fouls_won", w_rn("standard_fouls"), w_rn("standard_foul_ratio")]
    for n, r, _ in WON_SQL:
        won_cols += [w_rn(n), w_rn(r)]
    measure = [_zero(c) for c in committed_cols + won_cols]
    body = (f"SELECT team_name, player_name, player_id, team_id, {', '.join(measure)} "
            f"FROM fc FULL OUTER JOIN fw USING ({KEYS})")
    return _with(body, ("fc", fouls_committed_sql(where, c_rn)), ("fw", fouls_won_sql(where, w_rn)))


# --- sources ---------------------------------------------------------------

MATCHES = (
    "SELECT match_id, cast(900 + 2 * p AS BIGINT) AS home_team_id, "
    "'Team ' || cast(cast(900 + 2 * p AS BIGINT) AS VARCHAR) AS home_team_name, "
    "cast(901 + 2 * p AS BIGINT) AS away_team_id, "
    "'Team ' || cast(cast(901 + 2 * p AS BIGINT) AS VARCHAR) AS away_team_name, "
    "count(*) FILTER (WHERE shot_outcome = 'Goal' AND team_id = 900 + 2 * p) AS home_score, "
    "count(*) FILTER (WHERE shot_outcome = 'Goal' AND team_id = 901 + 2 * p) AS away_score "
    "FROM (SELECT *, floor((match_id - 3895000) / 10) AS p FROM me) AS m GROUP BY match_id, p"
)

COMPETITIONS = (
    "SELECT DISTINCT cast(competition_id AS BIGINT) AS competition_id, cast(season_id AS BIGINT) AS season_id, "
    "'Competition ' || cast(competition_id AS VARCHAR) AS competition_name, "
    "'Country ' || cast(competition_id AS VARCHAR) AS country_name, "
    "'Season ' || cast(season_id AS VARCHAR) AS season_name FROM me"
)

def _flat_events(where: str) -> str:
    """Player events and the line-up events, one per match, team and chunk of players."""
    return (
        "SELECT match_id, cast(event_id AS VARCHAR) AS id, type_name, team_id, player_name, minute, \"second\" "
        f"FROM me WHERE {where} "
        "UNION ALL "
        "SELECT DISTINCT match_id, 'xi-' || cast(match_id AS VARCHAR) || '-' || cast(team_id AS VARCHAR) || '-' || "
        f"cast(cast(floor(player_id / {LINEUP_CHUNK}) AS BIGINT) AS VARCHAR) AS id, 'Starting XI' AS type_name, "
        "team_id, NULL AS player_name, cast(0 AS BIGINT) AS minute, cast(0 AS BIGINT) AS \"second\" "
        f"FROM me WHERE {where}"
    )


def _whole_events(where: str) -> str:
    """Every field of player events, and the line-ups with the number of their players."""
    flags = [c for c in LEAVES if c.startswith(("block_", "foul_", "won_")) and c not in ("foul_type", "foul_card")] + ["recovery_failure"]
    own = {"id": "cast(event_id AS VARCHAR)", "event_index": "event_id", "players_listed": "0", "player_id": "cast(player_id AS VARCHAR)", "sub_in_id": "cast(sub_in_id AS VARCHAR)"}
    own |= {c: f"coalesce({c}, false)" for c in flags}
    columns = ", ".join(f"{own.get(c, chr(34) + c + chr(34))} AS {chr(34)}{c}{chr(34)}" for c in LEAVES)
    none = ", ".join(f"false AS {c}" for c in flags)
    return (
        f"SELECT {columns} FROM me WHERE {where} UNION ALL BY NAME "
        f"SELECT match_id, 'xi-' || match_id || '-' || team_id || '-' || cast(floor(player_id / {LINEUP_CHUNK}) AS BIGINT) AS id, 0 AS event_index, 'Starting XI' AS type_name, "
        "team_id, team_name, cast(0 AS BIGINT) AS minute, cast(0 AS BIGINT) AS \"second\", "
        f"{none}, "
        f"cast(count(DISTINCT player_id) AS INTEGER) AS players_listed FROM me WHERE {where} "
        f"GROUP BY match_id, team_id, team_name, cast(floor(player_id / {LINEUP_CHUNK}) AS BIGINT)"
    )


IN_SEASON = f"competition_id = {SEASON[0]} AND season_id = {SEASON[1]}"
SEASON_EVENTS = _flat_events(IN_SEASON)

SEASON_EVENTS_RELISTED = _flat_events(
    f"competition_id = {LATER_SEASON[0]} AND (season_id = {LATER_SEASON[1]} OR match_id % 10 = {RELISTED})"
)

EVENT_ARRAY = f"SELECT *, cast(row_number() OVER (ORDER BY match_id, id) - 1 AS BIGINT) AS place FROM ({_flat_events('true')}) AS e"

# The planted damage of the documents by the event's id; line-ups have no number and no damage.
DOCUMENT_FAILURES = (
    f"SELECT match_id, CASE event_id % {DAMAGE} "
    "WHEN 1 THEN 'field minute: bigint expected, string found' WHEN 2 THEN 'field type: struct expected, string found' "
    "WHEN 3 THEN 'field team.id: bigint expected, array found' WHEN 4 THEN 'broken json' WHEN 5 THEN 'no object' "
    "WHEN 6 THEN 'no element of an array' WHEN 7 THEN 'no object' WHEN 8 THEN 'field minute: bigint expected, decimal found' END AS reason, "
    f"count(*) AS n FROM me WHERE event_id % {DAMAGE} BETWEEN 1 AND 8 GROUP BY match_id, reason"
)

DRIFT_UNION = (
    "SELECT match_id, cast(event_id AS VARCHAR) AS id, CASE type_name WHEN 'Shot' THEN minute + 0.5 ELSE minute END::DOUBLE AS minute, "
    "CASE type_name WHEN 'Pass' THEN location_x END AS x, CASE type_name WHEN 'Shot' THEN '{\"name\":\"' || coalesce(shot_outcome, 'none') || '\"}' "
    "WHEN 'Pressure' THEN player_name END AS outcome FROM me WHERE type_name IN ('Pass', 'Shot', 'Pressure')"
)

MATCH_DOCUMENTS = "SELECT m.*, s.competition_id, s.season_id FROM ({}) AS m JOIN (SELECT DISTINCT match_id, cast(competition_id AS BIGINT) AS competition_id, cast(season_id AS BIGINT) AS season_id FROM me) AS s USING (match_id)"

JSON_ROWS = (
    "SELECT '{\"match_id\":' || match_id || ',\"id\":\"' || id || '\"' || "
    "CASE WHEN player_name IS NULL THEN '' ELSE ',\"player_name\":\"' || player_name || '\"' END || '}' AS json "
    f"FROM ({_flat_events('true')}) AS e"
)

ALIGN_UNION = " UNION ALL ".join(
    f"SELECT match_id, cast(event_id AS VARCHAR) AS id, {p} AS pass_outcome, {s} AS shot_outcome, {m} AS player_name FROM me WHERE type_name = '{t}'"
    for t, p, s, m in [
        ("Pass", "pass_outcome", "cast(NULL AS VARCHAR)", "cast(NULL AS VARCHAR)"),
        ("Shot", "cast(NULL AS VARCHAR)", "shot_outcome", "cast(NULL AS VARCHAR)"),
        ("Pressure", "cast(NULL AS VARCHAR)", "cast(NULL AS VARCHAR)", "player_name"),
    ]
)

FILLED_OUTER_JOIN = (
    f"SELECT {KEYS}, coalesce(total_shots, 0) AS total_shots, coalesce(goal, 0) AS goal, "
    f"coalesce(total_fouls_won, 0) AS total_fouls_won FROM s FULL OUTER JOIN f USING ({KEYS})"
)

# --- pitch analytics -------------------------------------------------------

PASS_VECTORS = (
    "SELECT team_name, team_id, player_name, player_id, location_x AS start_x, location_y AS start_y, "
    "end_x, end_y, pass_outcome IS NULL AS completed FROM me WHERE type_name = 'Pass'"
)

HEATMAP_COUNTS = (
    "SELECT player_id, cast(least(greatest(floor(location_x * 25 / 120.0), 0), 24) AS INTEGER) AS bin_x, "
    "cast(least(greatest(floor(location_y * 25 / 80.0), 0), 24) AS INTEGER) AS bin_y, count(*) AS n "
    "FROM me WHERE team_name IS NOT NULL AND player_name IS NOT NULL AND location_x IS NOT NULL "
    "GROUP BY ALL"
)

# The Gaussian filter's weights as they are, not rounded.
KERNEL_1D = (
    "SELECT src, tgt, sum(w) AS w FROM ("
    " SELECT CASE WHEN tgt + a < 0 THEN -1 - (tgt + a) WHEN tgt + a > 24 THEN 49 - (tgt + a)"
    "   ELSE tgt + a END AS src, tgt,"
    " exp(-0.5 * a * a) / (SELECT sum(exp(-0.5 * r * r)) FROM range(-4, 5) t(r)) AS w"
    " FROM (SELECT i AS tgt, unnest(range(-4, 5)) AS a FROM range(25) g(i)) AS taps"
    ") AS k GROUP BY src, tgt"
)

# The full 2-D convolution (81 taps, weight wx * wy), not the two passes.
HEATMAP_SMOOTH = (
    "SELECT g.player_id, cast(g.x AS INTEGER) AS bin_x, cast(g.y AS INTEGER) AS bin_y, "
    "coalesce(d.density, 0) AS density FROM "
    "(SELECT player_id, x, unnest(range(25)) AS y FROM "
    " (SELECT player_id, unnest(range(25)) AS x FROM (SELECT DISTINCT player_id FROM hc) AS p) AS q) AS g "
    "LEFT JOIN (SELECT c.player_id, kx.tgt AS x, ky.tgt AS y, "
    " round(fsum(c.n * kx.w * ky.w), 6) AS density "
    " FROM hc c JOIN k1 kx ON c.bin_x = kx.src JOIN k1 ky ON c.bin_y = ky.src "
    " GROUP BY c.player_id, kx.tgt, ky.tgt) AS d USING (player_id, x, y)"
)

SHOT_MAP = (
    "SELECT team_name, team_id, player_name, player_id, end_y AS x, end_z AS y, "
    "CASE WHEN shot_outcome = 'Goal' THEN 1 ELSE 0 END AS is_goal "
    "FROM me WHERE type_name = 'Shot' AND end_z IS NOT NULL"
)

SHOT_MAP_BOUNDS = (
    "SELECT team_id, player_id, x_min, x_max, y_max, goals, misses, max_x_dist, "
    "greatest(40.0 - max_x_dist, 32.0) AS x_lo, least(40.0 + max_x_dist, 47.0) AS x_hi FROM ("
    " SELECT *, greatest(abs(40.0 - x_max), abs(40.0 - x_min)) AS max_x_dist FROM ("
    "  SELECT team_id, player_id, min(x) AS x_min, max(x) AS x_max, max(y) AS y_max,"
    "  count(*) FILTER (WHERE is_goal = 1) AS goals, count(*) FILTER (WHERE is_goal <> 1) AS misses"
    "  FROM sm GROUP BY team_id, player_id) a) b"
)


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    pf = f"player_id = {PLAYER_ID}"
    tf = f"team_id = {TEAM_ID}"
    tn = f"team_name = '{TEAM_NAME}'"
    for key, fn in {**PLAYER_STAT_SQL, **ROW_STAT_SQL}.items():
        out[key] = _with(fn())
        out[f"{key}_player"] = _with(fn(pf))
    out["substitutions"] = _with(SUBSTITUTIONS)
    out["lineup"] = _with(lineup_sql(), ("lu", LINEUP_ROWS))
    out["team_players"] = _with(
        f"SELECT DISTINCT player_name AS name FROM me WHERE {tn} AND player_name IS NOT NULL")
    out["team_players_by_id"] = _with(
        f"SELECT DISTINCT player_name AS name, player_id AS id FROM me WHERE {tf} AND player_name IS NOT NULL")
    out["team_exact_passes"] = _with(exact_passes_sql(tf))
    out["team_exact_passes_by_name"] = _with(exact_passes_sql(tn))
    out["team_fouls"] = team_fouls_sql(tf)
    out["team_fouls_by_name"] = team_fouls_sql(tn)
    out["all_player_stats"] = all_player_stats_sql()
    out["team_match_stats"] = all_player_stats_sql(tf)
    out["team_match_stats_by_name"] = all_player_stats_sql(tn)
    out["competitions"] = _with(COMPETITIONS)
    out["matches"] = _with(MATCHES)
    out["season_events"] = _with(SEASON_EVENTS)
    out["pass_vectors"] = _with(PASS_VECTORS)
    out["heatmap_counts"] = _with(HEATMAP_COUNTS)
    out["heatmap_smooth"] = _with(HEATMAP_SMOOTH, ("hc", HEATMAP_COUNTS), ("k1", KERNEL_1D))
    out["shot_map"] = _with(SHOT_MAP)
    out["shot_map_bounds"] = _with(SHOT_MAP_BOUNDS, ("sm", SHOT_MAP))
    out["top_players"] = _with(
        "SELECT team_name, team_id, player_name, player_id, total_passes, pass_accuracy, "
        "cast(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
        "(PARTITION BY team_id ORDER BY pass_accuracy DESC, player_id, team_id, team_name, player_name) AS rn FROM ep) AS r "
        f"WHERE rn <= {TOP_N}", ("ep", exact_passes_sql()))
    out["top_players_overall"] = _with(
        "SELECT team_name, team_id, player_name, player_id, total_passes, pass_accuracy FROM ep "
        f"ORDER BY pass_accuracy DESC, player_id, team_id, team_name, player_name LIMIT {TOP_N}", ("ep", exact_passes_sql()))
    out["team_complete_rows"] = _with(
        f"SELECT * FROM ({time_on_ball_sql()}) AS t WHERE {tf} AND total_time_with_ball IS NOT NULL")
    out["event_documents"] = _with(_flat_events("true"))
    out["event_array_document"] = _with(EVENT_ARRAY)
    out["match_documents"] = _with(MATCH_DOCUMENTS.format(MATCHES))
    out["competition_documents"] = _with(COMPETITIONS)
    out["document_failures"] = _with(DOCUMENT_FAILURES)
    out["drift_union"] = _with(DRIFT_UNION)
    out["blocks_by_schema"] = _with(f"SELECT * EXCLUDE (counterpress_blocks, counterpress_block_ratio) FROM ({blocks_sql()}) AS b")
    out["season_events_relisted"] = _with(SEASON_EVENTS_RELISTED)
    out["season_events_semi_join"] = _with(SEASON_EVENTS)
    out["align_union"] = _with(ALIGN_UNION)
    out["json_rows"] = _with(JSON_ROWS)
    out["filled_outer_join"] = _with(FILLED_OUTER_JOIN, ("s", shots_sql()), ("f", fouls_won_sql()))
    st = f"team_id = {SEASON_TEAM} AND match_id IN (SELECT match_id FROM me WHERE {IN_SEASON})"
    out["entry_competitions"] = _with(COMPETITIONS)
    out["entry_matches"] = _with(
        f"SELECT m.* FROM ({MATCHES}) AS m WHERE m.match_id IN (SELECT match_id FROM me WHERE {IN_SEASON})")
    out["entry_match_all"] = _with(_whole_events(f"match_id = {MATCH_ID}"))
    out["entry_match_stat"] = _with(pass_accuracy_sql(f"match_id = {MATCH_ID}"))
    out["entry_season_stat"] = _with(shots_sql(IN_SEASON))
    out["entry_season_team_all"] = all_player_stats_sql(st)
    out["entry_season_team_foul"] = team_fouls_sql(st)
    out["entry_season_team_pass"] = _with(exact_passes_sql(st))
    out["entry_season_team_players"] = _with(
        f"SELECT DISTINCT player_name AS name, player_id AS id FROM me WHERE {st} AND player_name IS NOT NULL")
    out["entry_season_team_default"] = _with(
        "SELECT DISTINCT player_name AS name, player_id AS id FROM me WHERE team_id = 0 AND player_name IS NOT NULL")
    return out
