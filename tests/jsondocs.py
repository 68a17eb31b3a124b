"""Small match documents in the nested source form (FIXTURES.md §4)."""

from __future__ import annotations

import json
import os


def ref(i, name):
    return {"id": i, "name": name}


TEAM_A = ref(904, "Bayer Leverkusen")
TEAM_B = ref(169, "Bayern Munich")


def lineup_event(team, players):
    return {
        "id": f"xi-{team['id']}",
        "index": 1,
        "type": ref(35, "Starting XI"),
        "team": team,
        "minute": 0,
        "second": 0,
        "tactics": {
            "formation": 3421,
            "lineup": [
                {"player": ref(pid, name), "position": ref(pos_id, pos), "jersey_number": num}
                for pid, name, pos_id, pos, num in players
            ],
        },
    }


def ev(i, type_name, team, player, **extra):
    e = {
        "id": f"e{i}",
        "index": i,
        "type": ref(0, type_name),
        "team": team,
        "player": player,
        "position": ref(1, "Center Forward"),
        "minute": extra.pop("minute", 10),
        "second": extra.pop("second", 5),
        "location": extra.pop("location", [60.0, 40.0]),
    }
    e.update(extra)
    return e


WIRTZ = ref(40724, "Florian Wirtz")
XHAKA = ref(34870, "Granit Xhaka")
KANE = ref(10955, "Harry Kane")


def match_full():
    """Every field present (match 3895302)."""
    return [
        lineup_event(TEAM_A, [(40724, "Florian Wirtz", 19, "Center Attacking Midfield", 10),
                              (34870, "Granit Xhaka", 10, "Center Defensive Midfield", 34)]),
        lineup_event(TEAM_B, [(10955, "Harry Kane", 23, "Center Forward", 9)]),
        ev(2, "Pass", TEAM_A, WIRTZ, **{"pass": {"end_location": [70.0, 30.0], "body_part": ref(40, "Right Foot")}}),
        ev(3, "Pass", TEAM_A, WIRTZ, **{"pass": {"end_location": [80.0, 20.0], "outcome": ref(9, "Incomplete"),
                                              "body_part": ref(38, "Left Foot")}}),
        ev(4, "Pass", TEAM_A, XHAKA, **{"pass": {"end_location": [50.0, 50.0], "type": ref(66, "Recovery")}}),
        ev(5, "Shot", TEAM_A, WIRTZ, shot={"end_location": [120.0, 38.0, 1.2], "outcome": ref(97, "Goal")}),
        ev(6, "Shot", TEAM_B, KANE, shot={"end_location": [120.0, 45.0], "outcome": ref(98, "Off T")}),
        ev(7, "Carry", TEAM_A, WIRTZ, duration=12.5),
        ev(8, "Carry", TEAM_A, WIRTZ, duration=7.25),
        ev(9, "Dribble", TEAM_A, WIRTZ, dribble={"outcome": ref(8, "Complete")}),
        ev(10, "Ball Recovery", TEAM_A, XHAKA),
        ev(11, "Ball Recovery", TEAM_A, XHAKA, ball_recovery={"recovery_failure": True}),
        ev(12, "Block", TEAM_B, KANE),
        ev(13, "Block", TEAM_B, KANE, block={"deflection": True}),
        ev(14, "Foul Committed", TEAM_A, XHAKA, foul_committed={"type": ref(23, "Dive"), "card": ref(7, "Yellow Card")}),
        ev(15, "Foul Committed", TEAM_A, XHAKA),
        ev(16, "Foul Won", TEAM_B, KANE, foul_won={"advantage": True}),
        ev(17, "Pressure", TEAM_B, KANE),
        ev(18, "Substitution", TEAM_A, XHAKA, minute=104, second=3,
           substitution={"replacement": ref(1, "Sub Player"), "outcome": ref(103, "Tactical")}),
    ]


def match_drift():
    """No block, ball_recovery or foul fields anywhere (match 3895303)."""
    return [
        lineup_event(TEAM_A, [(40724, "Florian Wirtz", 19, "Center Attacking Midfield", 10)]),
        ev(2, "Pass", TEAM_A, WIRTZ, **{"pass": {"end_location": [70.0, 30.0]}}),
        ev(3, "Shot", TEAM_A, WIRTZ, shot={"end_location": [120.0, 40.0, 0.5], "outcome": ref(100, "Saved")}),
        ev(4, "Substitution", TEAM_A, WIRTZ, minute=7, second=9,
           substitution={"replacement": ref(2, "Other Sub"), "outcome": ref(102, "Injury")}),
    ]


def write_documents(root: str) -> dict[str, str]:
    """Write events/<match>.json (two good, one unreadable), a matches
    document and a competitions document under ``root``."""
    ev_dir = os.path.join(root, "events")
    os.makedirs(ev_dir, exist_ok=True)
    with open(os.path.join(ev_dir, "3895302.json"), "w") as f:
        json.dump(match_full(), f, indent=1)
    with open(os.path.join(ev_dir, "3895303.json"), "w") as f:
        json.dump(match_drift(), f, indent=1)
    with open(os.path.join(ev_dir, "3895304.json"), "w") as f:
        f.write('[{"id": "x", "type": {"name": "Pass"}, ')  # truncated download
    m_dir = os.path.join(root, "matches", "9")
    os.makedirs(m_dir, exist_ok=True)
    matches = [
        {"match_id": mid, "competition": {"competition_id": 9, "competition_name": "1. Bundesliga"},
         "season": {"season_id": 281, "season_name": "2023/2024"},
         "home_team": {"home_team_id": 904, "home_team_name": "Bayer Leverkusen"},
         "away_team": {"away_team_id": 169, "away_team_name": "Bayern Munich"},
         "home_score": 1, "away_score": 0}
        for mid in (3895302, 3895303)
    ] + [{"match_id": 3895999, "competition": {"competition_id": 9, "competition_name": "1. Bundesliga"},
          "season": {"season_id": 282, "season_name": "2024/2025"},
          "home_team": {"home_team_id": 1, "home_team_name": "X"},
          "away_team": {"away_team_id": 2, "away_team_name": "Y"}, "home_score": 0, "away_score": 0}]
    with open(os.path.join(m_dir, "281.json"), "w") as f:
        json.dump(matches, f)
    comp = [{"competition_id": 9, "season_id": 281, "competition_name": "1. Bundesliga",
             "country_name": "Germany", "season_name": "2023/2024", "extra_field": 1}]
    with open(os.path.join(root, "competitions.json"), "w") as f:
        json.dump(comp, f)
    return {
        "events": os.path.join(ev_dir, "*.json"),
        "matches": os.path.join(root, "matches", "*", "*.json"),
        "competitions": os.path.join(root, "competitions.json"),
    }
