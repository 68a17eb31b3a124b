"""Statistic semantics: defect fixes, invariants, catalog and plan shape."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from jsondocs import write_documents
from touchline.functions import measures as M
from touchline.operators import aggregations as A
from touchline.operators import projections as P
from touchline.operators import spatial as SP
from touchline.operators import team as TM
from touchline.plans import catalog
from touchline.sources import documents as S


@pytest.fixture(scope="module")
def doc_events(spark, tmp_path_factory):
    paths = write_documents(str(tmp_path_factory.mktemp("docs")))
    return S.split_corrupt(S.read_events(spark, paths["events"]).cache())[0]


def _rows(df):
    return [r.asDict() for r in df.collect()]


# --- defects of the source statistics, and what we return instead ----------

def test_lineup_keeps_team_id_and_sorted_positions(doc_events, events_small):
    rows = _rows(A.lineup(doc_events))
    assert {r["player_id"]: r["team_id"] for r in rows} == {40724: 904, 34870: 904, 10955: 169}
    # several positions per player, joined in sorted order
    multi = [r for r in _rows(A.lineup(events_small)) if "," in r["player_positions"]]
    assert multi and all(r["player_positions"].split(", ") == sorted(r["player_positions"].split(", ")) for r in multi)


def test_all_player_stats_runs_and_fills(doc_events):
    rows = {r["player_id"]: r for r in _rows(TM.all_player_stats(doc_events))}
    assert set(rows) == {40724, 34870, 10955}
    kane = rows[10955]
    assert kane["player_number"] == 9 and kane["total_passes"] == 0 and kane["pass_accuracy"] == 0.0
    assert kane["total_blocks"] == 2 and kane["deflection_blocks"] == 1 and kane["standard_blocks"] == 1
    wirtz = rows[40724]
    assert wirtz["total_passes"] == 3 and wirtz["accurate_passes"] == 2 and wirtz["pass_accuracy"] == 67.0
    assert wirtz["goal"] == 1 and wirtz["total_time_with_ball"] == round(19.75 / 60, 2)
    assert wirtz["player_positions"] == "Center Attacking Midfield"


def test_team_fouls_has_unique_prefixed_columns(doc_events):
    df = TM.team_fouls(doc_events, team_id=904)
    assert len(df.columns) == len(set(df.columns))
    for c in ("committed_standard_fouls", "won_standard_fouls", "committed_advantage_fouls",
              "won_penalty_foul_ratio", "dive_fouls", "dive_foul_ratio", "fouls_out", "foul_out_ratio",
              "six_seconds_fouls", "six_seconds_foul_ratio"):
        assert c in df.columns
    (x,) = [r for r in _rows(df) if r["player_id"] == 34870]
    assert x["total_fouls_committed"] == 2 and x["dive_fouls"] == 1 and x["card_fouls"] == 1
    assert x["dive_foul_ratio"] == 50.0 and x["total_fouls_won"] == 0 and x["won_standard_foul_ratio"] == 0.0


def test_foul_types_counted_by_value_and_fixed_columns(events_small):
    df = A.fouls_committed(events_small)
    totals = df.agg(*[F.sum(c).alias(c) for c in ("six_seconds_fouls", "backpass_pick_fouls",
                                                  "advantage_fouls")]).first()
    assert totals["six_seconds_fouls"] > 0 and totals["backpass_pick_fouls"] > 0
    assert "advantage_foul_ratio" in df.columns and totals["advantage_fouls"] > 0


def test_substitution_time_keeps_three_digit_minutes_and_match(doc_events):
    rows = _rows(P.substitutions(doc_events))
    assert [(r["match_id"], r["substitution_time"]) for r in rows] == [(3895302, "104:03"), (3895303, "07:09")]


def test_zero_division_gives_zero(doc_events):
    (r,) = [r for r in _rows(A.exact_passes(doc_events)) if r["player_id"] == 34870]
    assert r["total_head_passes"] == 0 and r["head_passes_accuracy"] == 0.0
    assert r["total_recovery_passes"] == 1 and r["recovery_passes_accuracy"] == 100.0


def test_completed_is_tested_on_the_outcome_name(doc_events):
    out = {r["end_location"][0]: r["outcome"] for r in _rows(P.pass_locations(doc_events))}
    assert out == {70.0: "Completed", 80.0: "Incomplete", 50.0: "Completed"}


# --- invariants --------------------------------------------------------------

def test_accurate_never_exceeds_total(events_small):
    df = A.exact_passes(events_small)
    names = [n for n, _ in M.exact_passes().counts]
    pairs = [(a, a.replace("accurate_", "total_", 1)) for a in names if a.startswith("accurate_")]
    assert len(pairs) == 10 and all(t in names for _, t in pairs)
    bad = df.filter(" OR ".join(f"{a} > {t}" for a, t in pairs))
    assert bad.count() == 0


def test_shot_outcome_groups_within_total(events_small):
    df = A.shots(events_small)
    assert df.filter("goal + blocked_or_saved_by_goalkeeper + not_on_target > total_shots").count() == 0


def test_one_pass_table_equals_join_of_separate_tables(events_small):
    one = TM.all_player_stats(events_small, sort=False)
    keys = ["player_name", "team_name", "team_id", "player_id"]
    from functools import reduce

    joined = reduce(lambda left, right: TM.filled_outer_join(keys, left, right), [
        A.lineup(events_small, sort=False),
        A.pass_accuracy(events_small, sort=False),
        A.shots(events_small, sort=False),
        A.dribbles(events_small, sort=False),
        A.ball_recoveries(events_small, sort=False),
        A.blocks(events_small, sort=False),
        A.time_on_ball(events_small, sort=False),
    ]).select(*one.columns)
    assert one.exceptAll(joined).count() == 0 and joined.exceptAll(one).count() == 0


@pytest.mark.parametrize("name", ["pass_acc", "pass_info", "shot", "possesion", "dribble", "recovery",
                                  "block", "fouls_commit", "fouls_won", "position", "pressure",
                                  "pass_localizations", "shot_localizations"])
def test_player_overload_equals_filter(events_small, name):
    pid = 7
    a = catalog.stat(name, events_small, player_id=pid)
    b = catalog.stat(name, events_small).filter(F.col("player_id") == pid)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_catalog_names(events_small):
    assert catalog.stat("all", events_small, player_id=3) is events_small
    assert catalog.stat("possession", events_small).columns == catalog.stat("possesion", events_small).columns
    with pytest.raises(ValueError):
        catalog.stat("nope", events_small)
    with pytest.raises(ValueError):
        catalog.team_stat("nope", events_small)
    by_name = catalog.team_stat("players", events_small, team_id=1, team_name="Team 904")
    assert by_name.columns == ["name"]
    assert catalog.team_stat("players", events_small, team_id=904).columns == ["name", "id"]
    for n in ("all", "foul", "pass"):
        assert catalog.team_stat(n, events_small, team_id=904).count() > 0


def test_top_players_and_complete_rows(events_small):
    top = SP.top_players(A.pass_accuracy(events_small, sort=False), "pass_accuracy", 2, ("team_id",))
    per_team = {r["team_id"]: r["n"] for r in top.groupBy("team_id").count().withColumnRenamed("count", "n").collect()}
    assert per_team and all(v <= 2 for v in per_team.values())
    overall = SP.top_players(A.pass_accuracy(events_small, sort=False), "pass_accuracy", 3)
    assert overall.count() == 3
    assert SP.team_complete_rows(A.time_on_ball(events_small), 904).filter("team_id <> 904").count() == 0


# --- plan shape ----------------------------------------------------------------

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_player_filter_and_type_reach_the_scan(spark, events_small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = _plan(A.pass_accuracy(events_small, player_id=7))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "EqualTo(type.name,Pass)" in scan and "EqualTo(player.id,7)" in scan
    # nested column pruning: only the leaves the statistic reads
    schema = scan.split("ReadSchema: ")[1]
    assert "shot" not in schema and "tactics" not in schema and "outcome:struct<name" in schema


def test_all_player_stats_reads_events_twice_without_cross_joins(events_small):
    plan = _plan(TM.all_player_stats(events_small))
    assert plan.count("FileScan parquet") == 2  # measures once, line-ups once
    # measures: one shuffle of partial aggregates, reused by the join; line-up:
    # one of partial aggregates, then its per-player rows once more for the join
    assert plan.count("Exchange hashpartitioning") == 3
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_heatmap_kernel_is_bounded_and_smoothing_joins_nothing(spark, events_small):
    kernel = SP.gaussian_axis_kernel(spark, 25)
    assert kernel.count() <= 25 * 9
    w = kernel.groupBy("tgt").agg(F.sum("w").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(float(w[0]) - 1) < 1e-11 and abs(float(w[1]) - 1) < 1e-11  # each target's weights sum to 1
    assert abs(math.fsum(SP.gaussian_taps()) - 1) < 1e-15
    plan = _plan(SP.heatmap(P.player_positions(events_small)))
    # one shuffle, of states that the tasks have merged; the kernel is part of the expression
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_approx_top_k" in plan
    assert "Join" not in plan and "Broadcast" not in plan


def test_heatmap_states_count_exactly(spark):
    """Every cell of the grid, from once to tens of thousands of times: the states' counts are the plain ones."""
    rows = spark.range(300_000).select(
        (F.col("id") % 3).alias("player_id"),
        F.array((F.sqrt(F.col("id") % 360_000) * 0.2), (F.pmod(F.hash("id"), F.lit(7919)) % 80).cast("double")).alias("location"),
    ).repartition(16)
    direct = {tuple(r)[:3]: r.density for r in SP.heatmap(rows).collect()}
    counted = {tuple(r)[:3]: r.density for r in SP.heatmap_smooth(SP.heatmap_counts(rows)).collect()}
    assert direct == counted and len(direct) == 3 * 625
    assert sum(direct.values()) == pytest.approx(300_000, abs=1e-2)
    assert max(r.n for r in SP.heatmap_counts(rows).collect()) > 300


def test_heatmap_of_other_grids(spark):
    rows = spark.createDataFrame([(1, [x * 1.0, 70.0]) for x in range(0, 120, 7)] + [(None, [0.0, 0.0]), (2, None), (3, [None, 1.0])], "player_id long, location array<double>")
    cells = SP.heatmap(rows, bins=(12, 5), sigma=0.5, truncate=3.0).collect()
    assert {r.player_id for r in cells} == {1, None} and len(cells) == 2 * 12 * 5
    assert sum(r.density for r in cells if r.player_id == 1) == pytest.approx(18, abs=1e-4)
    with pytest.raises(ValueError):
        SP.heatmap(rows, bins=(3, 3))


# --- API surface: ordering, source-shaped columns, schema helper ---------------

def test_catalog_orders_as_the_source(events_small):
    rows = catalog.stat("pass_acc", events_small).collect()
    keys = [(r.team_name, -r.pass_accuracy, r.player_id) for r in rows]
    assert keys == sorted(keys)
    subs = catalog.stat("subs", events_small).collect()
    assert [(r.match_id, r.team_name) for r in subs] == sorted((r.match_id, r.team_name) for r in subs)
    lineup = catalog.stat("players", events_small).collect()
    assert [(r.team_name, r.player_number) for r in lineup] == sorted((r.team_name, r.player_number) for r in lineup)


def test_drop_absent_gives_the_source_shape(doc_events):
    fixed = A.blocks(doc_events)
    trimmed = A.blocks(doc_events, drop_absent=True)
    assert "offensive_blocks" in fixed.columns
    assert trimmed.columns == ["team_name", "team_id", "player_id", "player_name", "total_blocks",
                               "standard_blocks", "standard_block_ratio", "deflection_blocks",
                               "deflection_block_ratio"]
    won = A.fouls_won(doc_events, drop_absent=True)
    assert "advantage_fouls" in won.columns and "penalty_fouls" not in won.columns
    committed = A.fouls_committed(doc_events, drop_absent=True)
    assert {"dive_fouls", "dive_foul_ratio", "card_fouls"} <= set(committed.columns)
    assert "handball_fouls" not in committed.columns


def test_source_entry_points(spark, tmp_path_factory):
    paths = write_documents(str(tmp_path_factory.mktemp("api")))
    events = S.split_corrupt(S.read_events(spark, paths["events"]).cache())[0]
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    comps = S.split_corrupt(S.read_competitions(spark, paths["competitions"]).cache())[0]
    assert catalog.competitions(comps).columns == ["competition_id", "season_id", "competition_name",
                                                   "country_name", "season_name"]
    assert "extra_field" not in catalog.competitions(comps, all=True).columns  # explicit schema
    assert catalog.matches(matches, 9, 281).count() == 2
    assert catalog.matches(matches, 9, 281, all=True).count() == 2
    one = catalog.match_stat(events, 3895303, "pass_acc").collect()
    assert [(r.player_id, r.total_passes) for r in one] == [(40724, 1)]
    season = catalog.season_stat(events, matches, 9, 281, "pass_acc", player_id=40724).collect()
    assert [(r.player_id, r.total_passes) for r in season] == [(40724, 3)]
    assert catalog.season_stat(events, matches, 9, 282, "shot").count() == 0
    team = catalog.season_team_stat(events, matches, 9, 281, "all", team_id=904)
    assert {r.player_id for r in team.collect()} == {40724, 34870}


def _events(spark, rows):
    from touchline.schemas import EVENT_SCHEMA

    full = []
    for r in rows:
        e = {f.name: None for f in EVENT_SCHEMA.fields}
        e.update(r)
        full.append(e)
    return spark.createDataFrame(full, EVENT_SCHEMA)


def test_outcome_struct_without_name_is_completed(spark):
    """A pass whose outcome struct exists but has no name is completed,
    in the location table and in the accuracy tables alike."""
    team, player = {"id": 1, "name": "T"}, {"id": 5, "name": "P"}
    ev = _events(spark, [
        {"id": "a", "index": 1, "match_id": 1, "type": {"id": None, "name": "Pass"}, "team": team,
         "player": player, "pass": {"end_location": [1.0, 1.0], "outcome": {"id": 9, "name": None},
                                    "body_part": None, "type": None}},
        {"id": "b", "index": 2, "match_id": 1, "type": {"id": None, "name": "Pass"}, "team": team,
         "player": player, "pass": {"end_location": [2.0, 2.0], "outcome": {"id": 9, "name": "Out"},
                                    "body_part": None, "type": None}},
    ])
    assert sorted(r.outcome for r in P.pass_locations(ev).collect()) == ["Completed", "Out"]
    (r,) = A.pass_accuracy(ev).collect()
    assert (r.total_passes, r.accurate_passes, r.pass_accuracy) == (2, 1, 50.0)
    (x,) = A.exact_passes(ev).collect()
    assert x.accurate_passes == 1


def test_two_jersey_numbers_give_two_rows(spark):
    """The all-player key includes the jersey number."""
    team = {"id": 1, "name": "T"}

    def xi(i, number):
        return {"id": f"xi{i}", "index": 0, "match_id": i, "type": {"id": None, "name": "Starting XI"},
                "team": team, "tactics": {"formation": None, "lineup": [
                    {"player": {"id": 5, "name": "P"}, "position": {"id": None, "name": "Left Wing"},
                     "jersey_number": number}]}}

    ev = _events(spark, [xi(1, 7), xi(2, 11), {
        "id": "p", "index": 1, "match_id": 1, "type": {"id": None, "name": "Pass"}, "team": team,
        "player": {"id": 5, "name": "P"},
        "pass": {"end_location": [1.0, 1.0], "outcome": None, "body_part": None, "type": None}}])
    rows = sorted((r.player_number, r.total_passes) for r in TM.all_player_stats(ev).collect())
    assert rows == [(7, 1), (11, 1)]


def test_source_shape_through_the_api(doc_events):
    fixed = catalog.stat("block", doc_events)
    shaped = catalog.stat("block", doc_events, source_shape=True)
    assert "offensive_blocks" in fixed.columns and "offensive_blocks" not in shaped.columns
    assert catalog.stat("pass_acc", doc_events, source_shape=True).columns == catalog.stat(
        "pass_acc", doc_events).columns
    one = catalog.match_stat(doc_events, 3895302, "fouls_won", source_shape=True)
    assert "penalty_fouls" not in one.columns and "advantage_fouls" in one.columns
