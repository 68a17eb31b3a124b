"""Landing, quarantine and season rules: nothing that was read is lost or doubled."""

from __future__ import annotations

import json
import os

import pytest
from jsondocs import TEAM_A, WIRTZ, ev
from pyspark.sql import functions as F
from touchline.operators import spatial as SP
from touchline.operators import team as TM
from touchline.plans import catalog
from touchline.sources import derived as D
from touchline.sources import documents as S
from touchline.sources.landing import land_events, land_matches, land_table, match_seasons
from touchline.sources.season import align_union, season_events


def _doc(folder, match_id, n=2, text=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{match_id}.json")
    with open(path, "w") as f:
        f.write(text if text is not None else json.dumps([ev(i, "Pass", TEAM_A, WIRTZ, **{"pass": {"end_location": [1.0, 1.0]}}) for i in range(n)]))
    return path


def _list(spark, rows):
    return spark.createDataFrame(
        [(m, (c, "C"), (s, "S")) for m, c, s in rows],
        "match_id bigint, competition struct<competition_id:bigint,competition_name:string>, season struct<season_id:bigint,season_name:string>",
    )


def _landed(spark, out):
    return {r.match_id: (r.season_id, r.n) for r in spark.read.parquet(out).groupBy("match_id", "season_id").agg(F.count("*").alias("n")).collect()}


def test_one_bad_field_costs_one_element(spark, scratch):
    good = [ev(i, "Pass", TEAM_A, WIRTZ) for i in range(3)]
    bad = dict(good[1], minute="abc")
    _doc(scratch, 1, text=json.dumps([good[0], bad, good[2]]))
    _doc(scratch, 2, text=json.dumps(good)[:-5])
    _doc(scratch, 3, text="")
    _doc(scratch, 4, text="[]")
    _doc(scratch, 5, text='[1, null, "x"]')
    good_rows, quarantine = S.split_corrupt(S.read_events(spark, os.path.join(scratch, "*.json")))
    assert [r.match_id for r in good_rows.collect()] == [1, 1]
    rows = {}
    for r in quarantine.collect():
        rows.setdefault(os.path.basename(r.source_file), []).append(r.raw_text)
    assert [json.loads(x)["minute"] for x in rows["1.json"]] == ["abc"]
    assert rows["2.json"] == [json.dumps(good)[:-5]]
    assert sorted(rows["5.json"]) == ["1", "null", "x"]
    assert set(rows) == {"1.json", "2.json", "5.json"}


def test_a_match_replaces_itself_only(spark, scratch):
    out, matches = os.path.join(scratch, "out"), _list(spark, [(1, 9, 281), (2, 9, 281), (3, 9, 282)])
    land = lambda *docs: land_events(S.read_events(spark, list(docs)), matches, out)
    land(_doc(scratch, 1))
    land(_doc(scratch, 2, 3))
    land(_doc(scratch, 3))
    assert _landed(spark, out) == {1: (281, 2), 2: (281, 3), 3: (282, 2)}
    land(_doc(scratch, 1, 5))
    assert _landed(spark, out) == {1: (281, 5), 2: (281, 3), 3: (282, 2)}
    # a match that moves to another season leaves its old one, which is then empty
    land_events(S.read_events(spark, _doc(scratch, 3)), _list(spark, [(3, 9, 281)]), out)
    assert _landed(spark, out) == {1: (281, 5), 2: (281, 3), 3: (281, 2)}
    assert not [f for f in os.listdir(scratch) if "staging" in f]


def test_unlisted_matches_wait(spark, scratch):
    out, none = os.path.join(scratch, "out"), _list(spark, [])
    land_events(S.read_events(spark, _doc(scratch, 1)), none, out)
    land_events(S.read_events(spark, _doc(scratch, 2)), none, out)
    pending = spark.read.parquet(f"{out}-pending")
    assert {r.match_id for r in pending.select("match_id").distinct().collect()} == {1, 2}
    land_events(S.read_events(spark, _doc(scratch, 3)), _list(spark, [(1, 9, 281), (3, 9, 281)]), out)
    assert _landed(spark, out) == {1: (281, 2), 3: (281, 2)}
    assert {r.match_id for r in spark.read.parquet(f"{out}-pending").select("match_id").distinct().collect()} == {2}


def test_quarantine_is_always_written_and_appended(spark, scratch):
    out, matches = os.path.join(scratch, "out"), _list(spark, [(1, 9, 281)])
    for match in (1, 2):
        land_events(S.read_events(spark, _doc(scratch, match, text="[{")), matches, out)
    assert len(spark.read.json(f"{out}-quarantine").collect()) == 2
    land_events(S.read_events(spark, _doc(scratch, "no-id")), matches, out)
    assert len(spark.read.json(f"{out}-quarantine").collect()) == 4


def test_conflicting_lists_and_corrupt_tables(spark, scratch):
    seasons, unclear = match_seasons(_list(spark, [(1, 9, 281), (1, 9, 281), (2, 9, 281), (2, 9, 282), (3, None, None)]))
    assert [r.match_id for r in seasons.collect()] == [1]
    assert sorted(r.match_id for r in unclear.collect()) == [2, 2, 3]
    out = os.path.join(scratch, "matches")
    land_matches(S.read_matches(spark, _doc(os.path.join(scratch, "9"), 281, text='[{"match_id": 5')), out)
    assert os.path.isdir(f"{out}-quarantine") and spark.read.json(f"{out}-quarantine").count() == 1
    land_table(S.read_competitions(spark, _doc(scratch, "competitions", text="[{")), os.path.join(scratch, "comps"))
    assert spark.read.parquet(os.path.join(scratch, "comps")).count() == 0
    assert spark.read.json(os.path.join(scratch, "comps-quarantine")).count() == 1


def test_landed_and_raw_events_give_the_same_season(spark, events_small):
    matches = D.load_matches(spark, "/root/testdata/sf0.001")
    key = lambda df: sorted((r.match_id, r.id) for r in df.select("match_id", "id").collect())
    for some in (matches, matches.limit(2), matches.limit(0)):
        landed = key(season_events(events_small, some, 9, 281))
        raw = key(season_events(events_small.drop("competition_id", "season_id"), some, 9, 281))
        assert landed == raw
    # landed before its match was listed
    early = events_small.withColumns({c: F.lit(None).cast("bigint") for c in ("competition_id", "season_id")})
    assert key(season_events(early, matches, 9, 281)) == key(season_events(events_small, matches, 9, 281)) != []


def test_default_team_and_precedence(events_small):
    for name in catalog.TEAM_STATS:
        assert catalog.team_stat(name, events_small).count() == 0
        by_name = catalog.team_stat(name, events_small, team_id=900, team_name="Team 904")
        assert sorted(map(str, by_name.collect())) == sorted(map(str, catalog.team_stat(name, events_small, team_name="Team 904").collect()))
    both = TM.team_fouls(events_small, team_id=900, team_name="Team 904")
    assert {r.team_id for r in both.collect()} == {904}


def test_ties_are_broken_by_all_keys(spark):
    rows = [("A", 1, "P", 7, 50.0), ("B", 2, "P", 7, 50.0), ("C", 3, "P", 7, 50.0)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "team_name string, team_id bigint, player_name string, player_id bigint, v double")
        assert [r.team_id for r in SP.top_players(df, "v", 2).collect()] == [1, 2]


def test_heatmap_counts_have_no_cap(spark):
    big = 9 * 10**18
    counts = spark.createDataFrame([(1, 12, 12, big)], "player_id bigint, bin_x int, bin_y int, n bigint")
    cells = SP.heatmap_smooth(counts).collect()
    assert len(cells) == 625
    assert sum(r.density for r in cells) == pytest.approx(big, rel=1e-6)


def test_source_changes_are_seen(spark, scratch):
    source = os.path.join(scratch, "sf")
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows.limit(50).write.parquet(f"{source}/events.parquet/day=1")
    first = D.load_match_events(spark, source).filter("player is not null").count()
    rows.limit(80).write.parquet(f"{source}/events.parquet/day=2")
    assert D.load_match_events(spark, source).filter("player is not null").count() > first


def test_only_published_versions_are_read(spark, scratch):
    source = os.path.join(scratch, "sf")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(100).write.parquet(f"{source}/events.parquet")
    events, _ = D.landed_paths(spark, source)
    want = spark.read.parquet(events).count()
    root = os.path.dirname(os.path.dirname(events)).removeprefix("file:")
    os.makedirs(f"{root}/0000/events")  # another landing that didn't end
    assert D.landed_paths(spark, source)[0] == events and D.load_match_events(spark, source).count() == want
    for marker in os.listdir(f"{root}/_published"):
        os.unlink(f"{root}/_published/{marker}")
    assert D.landed_paths(spark, source)[0] != events and D.load_match_events(spark, source).count() == want


def test_landing_failures_are_raised(spark, scratch):
    with pytest.raises(Exception, match="events.parquet"):
        D.load_match_events(spark, os.path.join(scratch, "missing"))


def test_many_frames_make_a_shallow_union(spark):
    df = align_union([spark.createDataFrame([(i,)], "a int") for i in range(40)])
    assert df.count() == 40


def test_derivation_by_hand(spark):
    """A few derived rows against values computed by hand from the given table."""
    raw = {r.event_id: r for r in spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(20).collect()}
    got = {int(r.id): r for r in D.load_match_events(spark, "/root/testdata/sf0.001").filter(F.col("player.id").isNotNull()).collect()}
    assert set(raw) <= set(got)
    for i, r in raw.items():
        assert got[i].team.id is not None and got[i].player.name and got[i].match_id >= 3895000
