"""Declarative measures of the aggregated player statistics (A2-A10).

A statistic is an event type, a list of conditional counts over that type's
events, and ratios over those counts. One spec drives both the single
statistic (filter to the type, one aggregation) and the all-player table,
which folds several specs into one aggregation over one scan instead of one
sub-plan and one full outer join per statistic.

Conditions are Spark SQL boolean expressions over the nested event columns
(``pass.outcome.name IS NULL``): one parse on the JVM per aggregate instead of
a Python round trip per column operation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# A condition is a Spark SQL boolean expression; None means "every row".
Cond = str


@dataclass(frozen=True)
class Ratio:
    """``round(part / whole * 100, scale)``; ``part`` and ``whole`` are column
    names or SQL expressions over the counts."""

    name: str
    part: str
    whole: str
    scale: int = 0


@dataclass(frozen=True)
class Stat:
    name: str
    event_type: str
    keys: tuple[str, ...]
    counts: tuple[tuple[str, Cond | None], ...]
    ratios: tuple[Ratio, ...] = ()
    # (output name, value column) summed exactly to minutes, rounded to 2.
    minutes: tuple[tuple[str, str], ...] = ()
    measure_columns: tuple[str, ...] = field(default=())
    sort_desc: str = ""

    def columns(self) -> list[str]:
        return list(self.keys) + list(self.measure_columns)


def sql_str(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _eq(path: str, value: str) -> Cond:
    return f"{path} = {sql_str(value)}"


def _isin(path: str, values: list[str]) -> Cond:
    return f"{path} IN ({', '.join(sql_str(v) for v in values)})"


def _null(path: str) -> Cond:
    return f"{path} IS NULL"


def _not_null(path: str) -> Cond:
    return f"{path} IS NOT NULL"


def _both(a: Cond, b: Cond) -> Cond:
    return f"({a}) AND ({b})"


KEYS_TTPP = ("team_name", "team_id", "player_name", "player_id")
KEYS_TTIP = ("team_name", "team_id", "player_id", "player_name")
KEYS_TPPT = ("team_name", "player_name", "player_id", "team_id")

PASS_COMPLETED = _null("pass.outcome.name")

# Pass breakdown of the exact pass table, in output order.
# (measure, field tested, value); "recovery" also needs no body part.
PASS_KINDS: list[tuple[str, str, str]] = [
    ("drop_kick", "pass.body_part.name", "Drop Kick"),
    ("head", "pass.body_part.name", "Head"),
    ("keeper_arm", "pass.body_part.name", "Keeper Arm"),
    ("left_foot", "pass.body_part.name", "Left Foot"),
    ("right_foot", "pass.body_part.name", "Right Foot"),
    ("other_body_part", "pass.body_part.name", "Other"),
    ("no_touch", "pass.body_part.name", "No Touch"),
    ("throw_in", "pass.type.name", "Throw-in"),
    ("recovery", "pass.type.name", "Recovery"),
]

# Shot outcomes.
SHOT_SAVED_OR_BLOCKED = ["Saved", "Saved off T", "Saved to Post", "Blocked"]
SHOT_OFF_TARGET = ["Off T", "Post", "Wayward"]

# Committed foul types counted by value of foul_committed.type.name.
FOUL_TYPES: list[tuple[str, str, str]] = [
    ("six_seconds_fouls", "six_seconds_foul_ratio", "6 Seconds"),
    ("backpass_pick_fouls", "backpass_pick_foul_ratio", "Backpass Pick"),
    ("dangerous_play_fouls", "dangerous_play_foul_ratio", "Dangerous Play"),
    ("dive_fouls", "dive_foul_ratio", "Dive"),
    ("fouls_out", "foul_out_ratio", "Foul Out"),
    ("handball_fouls", "handball_foul_ratio", "Handball"),
]
# Committed foul flags (field of foul_committed tested not null).
FOUL_FLAGS: list[tuple[str, str, str]] = [
    ("counterpress_fouls", "counterpress_foul_ratio", "counterpress"),
    ("offensive_fouls", "offensive_foul_ratio", "offensive"),
    ("advantage_fouls", "advantage_foul_ratio", "advantage"),
    ("penalty_fouls", "penalty_foul_ratio", "penalty"),
    ("card_fouls", "card_foul_ratio", "card"),
]
# Won foul flags, in output order.
FOUL_WON_FLAGS: list[tuple[str, str, str]] = [
    ("defensive_fouls", "defensive_foul_ratio", "defensive"),
    ("advantage_fouls", "advantage_foul_ratio", "advantage"),
    ("penalty_fouls", "penalty_foul_ratio", "penalty"),
]
# Block flags (field of block tested not null), in output order.
BLOCK_FLAGS: list[tuple[str, str, str]] = [
    ("deflection_blocks", "deflection_block_ratio", "deflection"),
    ("offensive_blocks", "offensive_block_ratio", "offensive"),
    ("save_blocks", "save_block_ratio", "save_block"),
    ("counterpress_blocks", "counterpress_block_ratio", "counterpress"),
]


def pass_accuracy() -> Stat:
    """A2: passes and the share completed (no outcome = completed)."""
    return Stat(
        name="pass_accuracy",
        event_type="Pass",
        keys=KEYS_TTPP,
        counts=(("total_passes", None), ("accurate_passes", PASS_COMPLETED)),
        ratios=(Ratio("pass_accuracy", "accurate_passes", "total_passes"),),
        measure_columns=("total_passes", "accurate_passes", "pass_accuracy"),
        sort_desc="pass_accuracy",
    )


def exact_passes() -> Stat:
    """A3: passes by body part and type, each completed / total / accuracy."""
    counts: list[tuple[str, Cond | None]] = [
        ("total_passes", None),
        ("accurate_passes", PASS_COMPLETED),
    ]
    ratios = [Ratio("pass_accuracy", "accurate_passes", "total_passes")]
    cols = ["accurate_passes", "total_passes", "pass_accuracy"]
    for kind, path, value in PASS_KINDS:
        cond = _eq(path, value)
        if kind == "recovery":
            cond = _both(cond, _null("pass.body_part.name"))
        acc, tot, ratio = f"accurate_{kind}_passes", f"total_{kind}_passes", f"{kind}_passes_accuracy"
        counts += [(acc, _both(PASS_COMPLETED, cond)), (tot, cond)]
        ratios.append(Ratio(ratio, acc, tot))
        cols += [acc, tot, ratio]
    return Stat(
        name="exact_passes",
        event_type="Pass",
        keys=KEYS_TTPP,
        counts=tuple(counts),
        ratios=tuple(ratios),
        measure_columns=tuple(cols),
        sort_desc="pass_accuracy",
    )


def shots() -> Stat:
    """A4: shots by outcome.

    As in the source statistic, blocked shots and outcomes in neither list
    count as on target, and ``shots_per_goal_ratio`` is goals per 100 shots.
    """
    return Stat(
        name="shots",
        event_type="Shot",
        keys=KEYS_TTPP,
        counts=(
            ("total_shots", None),
            ("goal", _eq("shot.outcome.name", "Goal")),
            ("blocked_or_saved_by_goalkeeper", _isin("shot.outcome.name", SHOT_SAVED_OR_BLOCKED)),
            ("not_on_target", _isin("shot.outcome.name", SHOT_OFF_TARGET)),
        ),
        ratios=(
            Ratio("on_target_accuracy", "total_shots - not_on_target", "total_shots"),
            Ratio("not_on_target_accuracy", "not_on_target", "total_shots"),
            Ratio("shots_per_goal_ratio", "goal", "total_shots"),
        ),
        measure_columns=(
            "total_shots",
            "goal",
            "blocked_or_saved_by_goalkeeper",
            "not_on_target",
            "on_target_accuracy",
            "not_on_target_accuracy",
            "shots_per_goal_ratio",
        ),
        sort_desc="on_target_accuracy",
    )


def time_on_ball() -> Stat:
    """A5: carry time in minutes, summed exactly and rounded to 2 decimals."""
    return Stat(
        name="time_on_ball",
        event_type="Carry",
        keys=KEYS_TTPP,
        counts=(),
        minutes=(("total_time_with_ball", "duration"),),
        measure_columns=("total_time_with_ball",),
        sort_desc="total_time_with_ball",
    )


def dribbles() -> Stat:
    """Dribbles and the share completed."""
    return Stat(
        name="dribbles",
        event_type="Dribble",
        keys=KEYS_TTPP,
        counts=(
            ("successful_dribbles", _eq("dribble.outcome.name", "Complete")),
            ("total_dribbles", None),
        ),
        ratios=(Ratio("dribbles_win_ratio", "successful_dribbles", "total_dribbles"),),
        measure_columns=("successful_dribbles", "total_dribbles", "dribbles_win_ratio"),
        sort_desc="dribbles_win_ratio",
    )


def ball_recoveries() -> Stat:
    """Recoveries; no ``recovery_failure`` flag = successful."""
    return Stat(
        name="ball_recoveries",
        event_type="Ball Recovery",
        keys=KEYS_TPPT,
        counts=(
            ("successful_ball_recoveries", _null("ball_recovery.recovery_failure")),
            ("total_ball_recoveries", None),
        ),
        ratios=(
            Ratio("ball_recovery_ratio", "successful_ball_recoveries", "total_ball_recoveries"),
        ),
        measure_columns=(
            "successful_ball_recoveries",
            "total_ball_recoveries",
            "ball_recovery_ratio",
        ),
        sort_desc="ball_recovery_ratio",
    )


def blocks() -> Stat:
    """Blocks; no ``block`` detail = standard block. Fixed columns."""
    counts: list[tuple[str, Cond | None]] = [
        ("total_blocks", None),
        ("standard_blocks", _null("block")),
    ]
    ratios = [Ratio("standard_block_ratio", "standard_blocks", "total_blocks")]
    cols = ["total_blocks", "standard_blocks", "standard_block_ratio"]
    for count, ratio, flag in BLOCK_FLAGS:
        counts.append((count, _not_null(f"block.{flag}")))
        ratios.append(Ratio(ratio, count, "total_blocks"))
        cols += [count, ratio]
    return Stat(
        name="blocks",
        event_type="Block",
        keys=KEYS_TTIP,
        counts=tuple(counts),
        ratios=tuple(ratios),
        measure_columns=tuple(cols),
        sort_desc="total_blocks",
    )


def fouls_committed() -> Stat:
    """Committed fouls by type and flag, ratios at 2 decimals. Fixed columns."""
    total = "total_fouls_committed"
    counts: list[tuple[str, Cond | None]] = [
        (total, None),
        ("standard_fouls", _null("foul_committed")),
    ]
    ratios = [Ratio("standard_foul_ratio", "standard_fouls", total, 2)]
    cols = [total, "standard_fouls", "standard_foul_ratio"]
    for count, ratio, value in FOUL_TYPES:
        counts.append((count, _eq("foul_committed.type.name", value)))
        ratios.append(Ratio(ratio, count, total, 2))
        cols += [count, ratio]
    for count, ratio, flag in FOUL_FLAGS:
        counts.append((count, _not_null(f"foul_committed.{flag}")))
        ratios.append(Ratio(ratio, count, total, 2))
        cols += [count, ratio]
    return Stat(
        name="fouls_committed",
        event_type="Foul Committed",
        keys=KEYS_TPPT,
        counts=tuple(counts),
        ratios=tuple(ratios),
        measure_columns=tuple(cols),
        sort_desc=total,
    )


def fouls_won() -> Stat:
    """A10: fouls won by flag, ratios at 2 decimals. Fixed columns."""
    total = "total_fouls_won"
    counts: list[tuple[str, Cond | None]] = [
        (total, None),
        ("standard_fouls", _null("foul_won")),
    ]
    ratios = [Ratio("standard_foul_ratio", "standard_fouls", total, 2)]
    cols = [total, "standard_fouls", "standard_foul_ratio"]
    for count, ratio, flag in FOUL_WON_FLAGS:
        counts.append((count, _not_null(f"foul_won.{flag}")))
        ratios.append(Ratio(ratio, count, total, 2))
        cols += [count, ratio]
    return Stat(
        name="fouls_won",
        event_type="Foul Won",
        keys=KEYS_TPPT,
        counts=tuple(counts),
        ratios=tuple(ratios),
        measure_columns=tuple(cols),
        sort_desc=total,
    )


def renamed(stat: Stat, mapping: dict[str, str]) -> Stat:
    """The same statistic with some measure columns renamed."""

    def rn(name: str) -> str:
        return mapping.get(name, name)

    return Stat(
        name=stat.name,
        event_type=stat.event_type,
        keys=stat.keys,
        counts=tuple((rn(n), c) for n, c in stat.counts),
        ratios=tuple(Ratio(rn(r.name), rn(r.part), rn(r.whole), r.scale) for r in stat.ratios),
        minutes=tuple((rn(n), v) for n, v in stat.minutes),
        measure_columns=tuple(rn(c) for c in stat.measure_columns),
        sort_desc=rn(stat.sort_desc),
    )
