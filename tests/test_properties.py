"""Brute-force checks on small generated fixtures (hypothesis)."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline.operators import aggregations as A
from touchline.operators import spatial as SP
from touchline.operators import team as TM
from touchline.schemas import EVENT_SCHEMA

TYPES = ["Pass", "Shot", "Dribble", "Ball Recovery", "Block", "Carry", "Pressure"]
SHOT_OUTCOMES = [None, "Goal", "Saved", "Blocked", "Off T", "Post", "Wayward", "Saved to Post"]
PLAYERS = [(1, "A", 10, "Red"), (2, "B", 10, "Red"), (3, "C", 20, "Blue"), (None, None, 20, "Blue")]


def _ref(i, name):
    return None if name is None else {"id": i, "name": name}


@st.composite
def event_rows(draw):
    rows = []
    for i in range(draw(st.integers(0, 25))):
        pid, pname, tid, tname = draw(st.sampled_from(PLAYERS))
        t = draw(st.sampled_from(TYPES))
        e = {f.name: None for f in EVENT_SCHEMA.fields}
        e.update(id=str(i), index=i, match_id=1, minute=1, second=2,
                 type={"id": None, "name": t}, team=_ref(tid, tname), player=_ref(pid, pname))
        if t == "Pass":
            e["pass"] = {"end_location": [1.0, 2.0], "outcome": _ref(None, draw(st.sampled_from([None, "Incomplete"]))),
                         "body_part": None, "type": None}
        if t == "Shot":
            e["shot"] = {"end_location": [1.0, 2.0], "outcome": _ref(None, draw(st.sampled_from(SHOT_OUTCOMES)))}
        if t == "Dribble":
            e["dribble"] = {"outcome": _ref(None, draw(st.sampled_from(["Complete", "Incomplete"])))}
        if t == "Ball Recovery" and draw(st.booleans()):
            e["ball_recovery"] = {"recovery_failure": True}
        if t == "Block" and draw(st.booleans()):
            e["block"] = {"deflection": draw(st.sampled_from([None, True])), "offensive": None,
                          "save_block": None, "counterpress": None}
        if t == "Carry":
            e["duration"] = draw(st.sampled_from([0.5, 1.25, 2.0, 3.75]))
        rows.append(e)
    return rows


def _pct(a, b):
    """Spark's round: half up, on the double's shortest decimal form."""
    if not b:
        return 0.0
    return float(Decimal(repr(a / b * 100)).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def _brute(rows):
    acc = defaultdict(lambda: defaultdict(float))
    for e in rows:
        if e["player"] is None or e["type"]["name"] not in TYPES[:-1]:
            continue
        k = (e["team"]["name"], e["team"]["id"], e["player"]["name"], e["player"]["id"])
        m = acc[k]
        t = e["type"]["name"]
        if t == "Pass":
            m["total_passes"] += 1
            m["accurate_passes"] += e["pass"]["outcome"] is None
        elif t == "Shot":
            o = e["shot"]["outcome"] and e["shot"]["outcome"]["name"]
            m["total_shots"] += 1
            m["goal"] += o == "Goal"
            m["not_on_target"] += o in ("Off T", "Post", "Wayward")
        elif t == "Dribble":
            m["total_dribbles"] += 1
            m["successful_dribbles"] += e["dribble"]["outcome"]["name"] == "Complete"
        elif t == "Ball Recovery":
            m["total_ball_recoveries"] += 1
            m["successful_ball_recoveries"] += e["ball_recovery"] is None
        elif t == "Block":
            m["total_blocks"] += 1
            m["standard_blocks"] += e["block"] is None
            m["deflection_blocks"] += e["block"] is not None and e["block"]["deflection"] is not None
        elif t == "Carry":
            m["seconds"] += e["duration"]
    return acc


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=event_rows())
def test_one_pass_table_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, EVENT_SCHEMA) if rows else spark.createDataFrame([], EVENT_SCHEMA)
    got = {(r.team_name, r.team_id, r.player_name, r.player_id): r
           for r in TM.all_player_stats(df, sort=False).collect()}
    want = _brute(rows)
    assert set(got) == set(want)
    for k, m in want.items():
        r = got[k]
        assert r.total_passes == m["total_passes"] and r.accurate_passes == m["accurate_passes"]
        assert r.pass_accuracy == _pct(m["accurate_passes"], m["total_passes"])
        assert r.goal == m["goal"] and r.not_on_target == m["not_on_target"]
        assert r.on_target_accuracy == _pct(m["total_shots"] - m["not_on_target"], m["total_shots"])
        assert r.successful_dribbles == m["successful_dribbles"]
        assert r.ball_recovery_ratio == _pct(m["successful_ball_recoveries"], m["total_ball_recoveries"])
        assert r.standard_blocks == m["standard_blocks"] and r.deflection_blocks == m["deflection_blocks"]
        minutes = (Decimal(repr(m["seconds"])) / 60).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r.total_time_with_ball == float(minutes)


def _numpy_gaussian(counts: np.ndarray, sigma=1.0, truncate=4.0) -> np.ndarray:
    """Separable Gaussian filter with reflected edges (d c b a | a b c d)."""
    r = int(truncate * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    w /= w.sum()
    padded = np.pad(counts, r, mode="symmetric")
    out = np.zeros_like(counts, dtype=float)
    n0, n1 = counts.shape
    for i in range(n0):
        for j in range(n1):
            out[i, j] = (w[:, None] * w[None, :] * padded[i:i + 2 * r + 1, j:j + 2 * r + 1]).sum()
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(points=st.lists(st.tuples(st.integers(0, 1199), st.integers(0, 799)), min_size=1, max_size=40))
def test_heatmap_matches_numpy_filter(spark, points):
    rows = [(7, [x / 10, y / 10]) for x, y in points]
    df = spark.createDataFrame(rows, "player_id long, location array<double>")
    counts = SP.heatmap_counts(df)
    got = {(r.bin_x, r.bin_y): r.density for r in SP.heatmap_smooth(counts).collect()}
    grid = np.zeros((25, 25))
    for r in counts.collect():
        grid[r.bin_x, r.bin_y] = r.n
    want = _numpy_gaussian(grid)
    for (i, j), v in got.items():
        assert abs(v - want[i, j]) < 2e-6
    # every cell of the grid is listed
    assert {(i, j) for i in range(25) for j in range(25)} == set(got)
    # mass is preserved by the reflected filter
    assert abs(sum(got.values()) - len(points)) < 1e-3


FOUL_TYPES = [None, "6 Seconds", "Backpass Pick", "Dangerous Play", "Dive", "Foul Out", "Handball"]


@st.composite
def foul_rows(draw):
    rows = []
    for i in range(draw(st.integers(1, 30))):
        pid, pname, tid, tname = draw(st.sampled_from(PLAYERS[:3]))
        won = draw(st.booleans())
        e = {f.name: None for f in EVENT_SCHEMA.fields}
        e.update(id=str(i), index=i, match_id=1, team=_ref(tid, tname), player=_ref(pid, pname),
                 type={"id": None, "name": "Foul Won" if won else "Foul Committed"})
        if draw(st.booleans()):
            flag = lambda: draw(st.sampled_from([None, True]))
            if won:
                e["foul_won"] = {"defensive": flag(), "advantage": flag(), "penalty": flag()}
            else:
                e["foul_committed"] = {"type": _ref(None, draw(st.sampled_from(FOUL_TYPES))),
                                       "counterpress": flag(), "offensive": flag(), "advantage": flag(),
                                       "penalty": flag(), "card": _ref(None, draw(st.sampled_from([None, "Yellow Card"])))}
        rows.append(e)
    return rows


def _pct2(a, b):
    return float(Decimal(repr(a / b * 100)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=foul_rows())
def test_foul_tables_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    committed = {r.player_id: r.asDict() for r in A.fouls_committed(df, sort=False).collect()}
    won = {r.player_id: r.asDict() for r in A.fouls_won(df, sort=False).collect()}
    want_c, want_w = defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int))
    for e in rows:
        pid = e["player"]["id"]
        if e["type"]["name"] == "Foul Committed":
            m, fc = want_c[pid], e["foul_committed"]
            m["total_fouls_committed"] += 1
            m["standard_fouls"] += fc is None
            if fc is not None:
                kind = fc["type"] and fc["type"]["name"]
                for name, value in (("six_seconds_fouls", "6 Seconds"), ("backpass_pick_fouls", "Backpass Pick"),
                                    ("dangerous_play_fouls", "Dangerous Play"), ("dive_fouls", "Dive"),
                                    ("fouls_out", "Foul Out"), ("handball_fouls", "Handball")):
                    m[name] += kind == value
                for flag in ("counterpress", "offensive", "advantage", "penalty", "card"):
                    m[f"{flag}_fouls"] += fc[flag] is not None
        else:
            m, fw = want_w[pid], e["foul_won"]
            m["total_fouls_won"] += 1
            m["standard_fouls"] += fw is None
            if fw is not None:
                for flag in ("defensive", "advantage", "penalty"):
                    m[f"{flag}_fouls"] += fw[flag] is not None
    assert set(committed) == set(want_c) and set(won) == set(want_w)
    for pid, m in want_c.items():
        got = committed[pid]
        for name, v in m.items():
            assert got[name] == v, (name, got[name], v)
        assert got["dive_foul_ratio"] == _pct2(m["dive_fouls"], m["total_fouls_committed"])
        assert got["standard_foul_ratio"] == _pct2(m["standard_fouls"], m["total_fouls_committed"])
    for pid, m in want_w.items():
        got = won[pid]
        for name, v in m.items():
            assert got[name] == v, (name, got[name], v)
        assert got["penalty_foul_ratio"] == _pct2(m["penalty_fouls"], m["total_fouls_won"])


def test_match_clock_format_every_value(spark):
    from pyspark.sql import functions as F

    from touchline.functions.columns import mm_ss

    df = spark.range(131 * 60).select((F.col("id") / 60).cast("long").alias("m"), (F.col("id") % 60).alias("s"))
    got = {(r.m, r.s): r.t for r in df.select("m", "s", mm_ss(F.col("m"), F.col("s")).alias("t")).collect()}
    assert len(got) == 131 * 60
    assert all(t == f"{m:02d}:{s:02d}" for (m, s), t in got.items())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(entries=st.lists(st.tuples(st.integers(1, 4), st.sampled_from([7, 9]),
                                  st.sampled_from(["Left Wing", "Center Back", "Goalkeeper"])),
                        min_size=1, max_size=12))
def test_lineup_matches_brute_force(spark, entries):
    team = {"id": 1, "name": "T"}
    rows = []
    for i, (pid, number, pos) in enumerate(entries):
        e = {f.name: None for f in EVENT_SCHEMA.fields}
        e.update(id=f"xi{i}", index=0, match_id=i, team=team, type={"id": None, "name": "Starting XI"},
                 tactics={"formation": None, "lineup": [
                     {"player": {"id": pid, "name": f"P{pid}"}, "position": {"id": None, "name": pos},
                      "jersey_number": number}]})
        rows.append(e)
    got = {(r.player_id, r.player_number): r.player_positions
           for r in A.lineup(spark.createDataFrame(rows, EVENT_SCHEMA)).collect()}
    want = defaultdict(set)
    for pid, number, pos in entries:
        want[(pid, number)].add(pos)
    assert got == {k: ", ".join(sorted(v)) for k, v in want.items()}
