"""JSON document sources, quarantine, landing and season selection."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from jsondocs import write_documents
from touchline.operators import aggregations as A
from touchline.operators import projections as P
from touchline.sources import documents as S
from touchline.sources.landing import json_rows, land_events, land_table, write_json
from touchline.sources.season import align_union, season_events, season_match_ids


def _docs(scratch):
    return write_documents(scratch)


def test_events_from_many_documents_carry_match_id(spark, scratch):
    paths = _docs(scratch)
    good, bad = S.split_corrupt(S.read_events(spark, paths["events"]).cache())
    per_match = {r["match_id"]: r["n"] for r in good.groupBy("match_id").agg(F.count("*").alias("n")).collect()}
    assert per_match == {3895302: 19, 3895303: 4}
    bad_rows = bad.collect()
    assert len(bad_rows) == 1
    assert bad_rows[0]["source_file"].endswith("3895304.json")
    assert bad_rows[0]["raw_text"].startswith('[{"id": "x"')


def test_schema_drift_gives_null_columns_not_errors(spark, scratch):
    paths = _docs(scratch)
    good, _ = S.split_corrupt(S.read_events(spark, paths["events"]).cache())
    drift = good.filter(F.col("match_id") == 3895303)
    # Statistics over fields the documents never mention still analyse and run.
    assert A.blocks(drift).count() == 0
    assert A.fouls_committed(drift).count() == 0
    rec = A.ball_recoveries(good).collect()
    assert [(r["successful_ball_recoveries"], r["total_ball_recoveries"]) for r in rec] == [(1, 2)]


def test_competitions_and_matches_documents(spark, scratch):
    paths = _docs(scratch)
    comps = P.competitions(S.split_corrupt(S.read_competitions(spark, paths["competitions"]))[0]).collect()
    assert [(r.competition_id, r.season_id, r.country_name) for r in comps] == [(9, 281, "Germany")]
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    rows = P.matches(matches).orderBy("match_id").collect()
    assert [r.match_id for r in rows] == [3895302, 3895303, 3895999]
    assert rows[0].home_team_name == "Bayer Leverkusen" and rows[0].home_score == 1


def test_season_selection_is_a_semi_join(spark, scratch):
    paths = _docs(scratch)
    events = S.split_corrupt(S.read_events(spark, paths["events"]).cache())[0]
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    ids = sorted(r.match_id for r in season_match_ids(matches, 9, 281).collect())
    assert ids == [3895302, 3895303]
    season = season_events(events, matches, 9, 281)
    assert season.count() == 23
    assert season_events(events, matches, 9, 282).count() == 0
    plan = season._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_landing_partitions_by_season_and_quarantines(spark, scratch):
    paths = _docs(scratch)
    events = S.read_events(spark, paths["events"]).cache()
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    out, q = os.path.join(scratch, "landed"), os.path.join(scratch, "quarantine")
    land_events(events, matches, out, quarantine_path=q)
    assert os.path.isdir(os.path.join(out, "competition_id=9", "season_id=281"))
    landed = spark.read.parquet(out)
    assert landed.count() == 23
    (q_row,) = spark.read.json(q).collect()
    assert q_row.source_file.endswith("3895304.json") and q_row.raw_text.startswith("[")
    # A statistic on landed data equals the same statistic on the documents.
    a = sorted(map(tuple, A.pass_accuracy(landed, sort=False).collect()))
    b = sorted(map(tuple, A.pass_accuracy(S.split_corrupt(events)[0], sort=False).collect()))
    assert a == b
    land_table(matches, os.path.join(scratch, "matches_pq"))
    assert spark.read.parquet(os.path.join(scratch, "matches_pq")).count() == 3


def test_json_sink_omits_nulls(spark, scratch):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = sorted(r.json for r in json_rows(df).collect())
    assert rows == ['{"a":1}', '{"a":2,"b":"x"}']
    out = os.path.join(scratch, "sink")
    write_json(df, out)
    assert spark.read.json(out).count() == 2


def test_align_union_fills_missing_fields(spark):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([(2,)], "id long")
    rows = sorted(map(tuple, align_union([a, b]).collect()), key=lambda r: r[0])
    assert rows == [(1, "x"), (2, None)]


def test_match_ids_from_the_path_when_missing(spark, scratch):
    import json

    d = os.path.join(scratch, "matches", "11")
    os.makedirs(d)
    with open(os.path.join(d, "90.json"), "w") as f:
        json.dump([{"match_id": 5, "home_team": {"home_team_id": 1, "home_team_name": "X"},
                    "away_team": {"away_team_id": 2, "away_team_name": "Y"},
                    "home_score": 2, "away_score": 1}], f)
    m = S.split_corrupt(S.read_matches(spark, os.path.join(scratch, "matches", "*", "*.json")).cache())[0]
    (r,) = m.select("competition.competition_id", "season.season_id").collect()
    assert (r[0], r[1]) == (11, 90)


def test_landing_is_atomic_and_reused(spark):
    import uuid as _uuid

    from touchline.sources import derived as D

    spark.conf.set(D.LANDING_TAG_CONF, _uuid.uuid4().hex)
    try:
        a = D.landed_paths(spark, "/root/testdata/sf0.001")
        b = D.landed_paths(spark, "/root/testdata/sf0.001")
        assert a == b
        parent = a[0].rsplit("/", 1)[0].replace("file:", "")
        assert not [n for n in os.listdir(parent) if ".tmp-" in n]
        assert spark.read.parquet(a[0]).count() > 0
    finally:
        spark.conf.unset(D.LANDING_TAG_CONF)


def test_documents_round_trip_equals_landed_tables(spark, scratch, events_small):
    """Derived events written as one JSON document per match (the source
    format), read back through the document source: every statistic agrees
    with the landed table."""
    import json

    from touchline.operators import team as TM
    from touchline.schemas import EVENT_DOCUMENT_SCHEMA

    doc_cols = EVENT_DOCUMENT_SCHEMA.fieldNames()
    per_match: dict[int, list] = {}
    for r in events_small.select("match_id", F.to_json(F.struct(*doc_cols)).alias("j")).collect():
        per_match.setdefault(r.match_id, []).append(r.j)
    ev_dir = os.path.join(scratch, "events")
    os.makedirs(ev_dir)
    for match_id, docs in per_match.items():
        with open(os.path.join(ev_dir, f"{match_id}.json"), "w") as f:
            f.write("[" + ",\n".join(docs) + "]")
    from_docs, bad = S.split_corrupt(S.read_events(spark, os.path.join(ev_dir, "*.json")).cache())
    assert bad.count() == 0
    assert from_docs.count() == events_small.count()

    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(TM.all_player_stats(from_docs, sort=False)) == rows(TM.all_player_stats(events_small, sort=False))
    assert rows(A.fouls_committed(from_docs, sort=False)) == rows(A.fouls_committed(events_small, sort=False))
    assert rows(P.substitutions(from_docs, sort=False)) == rows(P.substitutions(events_small, sort=False))
    assert json.loads(open(os.path.join(ev_dir, f"{min(per_match)}.json")).read())  # valid JSON array


def test_json_lines_documents(spark, scratch):
    import json

    path = os.path.join(scratch, "lines.json")
    with open(path, "w") as f:
        for i in range(3):
            f.write(json.dumps({"competition_id": 9, "season_id": 280 + i, "country_name": "X"}) + "\n")
        f.write("{not json\n")
    from touchline.schemas import COMPETITION_SCHEMA

    df = S.read_json_documents(spark, path, COMPETITION_SCHEMA, multi_line=False).cache()
    good, bad = S.split_corrupt(df)
    assert sorted(r.season_id for r in good.collect()) == [280, 281, 282]
    assert [r.raw_text for r in bad.collect()] == ["{not json"]


def test_duplicate_match_listing_does_not_double_events(spark, scratch):
    paths = _docs(scratch)
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    doubled = matches.unionByName(matches)
    out = os.path.join(scratch, "landed_dup")
    land_events(S.read_events(spark, paths["events"]), doubled, out)
    assert spark.read.parquet(out).count() == 23


def test_unknown_fields_report_drift(spark, scratch):
    import json

    from touchline.schemas import EVENT_DOCUMENT_SCHEMA

    d = os.path.join(scratch, "ev")
    os.makedirs(d)
    doc = [{"id": "1", "type": {"id": 30, "name": "Pass"},
            "pass": {"outcome": {"name": "Out"}, "technique": {"id": 1, "name": "Through Ball"}},
            "related_events": ["a", "b"], "tactics": {"lineup": [{"jersey_number": 3, "country": "X"}]}}]
    with open(os.path.join(d, "1.json"), "w") as f:
        json.dump(doc, f)
    got = S.unknown_fields(spark, os.path.join(d, "*.json"), EVENT_DOCUMENT_SCHEMA, sampling_ratio=1.0)
    assert got == ["pass.technique", "pass.technique.id", "pass.technique.name", "related_events",
                   "tactics.lineup.country"]


def test_ingest_cli(spark, scratch, monkeypatch):
    import importlib.util
    import sys

    paths = _docs(scratch)
    spec = importlib.util.spec_from_file_location(
        "land_cli", os.path.join(os.path.dirname(__file__), "..", "scripts", "land.py"))
    cli = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(cli)
    out = os.path.join(scratch, "cli_out")
    monkeypatch.setattr(sys, "argv", ["land.py", "--events", paths["events"], "--matches", paths["matches"],
                                      "--competitions", paths["competitions"], "--out", out])
    cli.main()
    assert spark.read.parquet(os.path.join(out, "events")).count() == 23
    assert spark.read.parquet(os.path.join(out, "matches")).count() == 3
    assert spark.read.parquet(os.path.join(out, "competitions")).count() == 1
    (q,) = spark.read.json(os.path.join(out, "quarantine")).collect()
    assert q.source_file.endswith("3895304.json")


def test_stat_cli_routes(spark, scratch, monkeypatch):
    import importlib.util
    import sys

    paths = _docs(scratch)
    here = os.path.join(os.path.dirname(__file__), "..", "scripts")

    def load(name):
        spec = importlib.util.spec_from_file_location(name, os.path.join(here, f"{name}.py"))
        mod = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(mod)
        return mod

    landed = os.path.join(scratch, "landed_cli")
    monkeypatch.setattr(sys, "argv", ["land.py", "--events", paths["events"], "--matches", paths["matches"],
                                      "--competitions", paths["competitions"], "--out", landed])
    load("land").main()
    stat = load("stat")

    def run(*route):
        out = os.path.join(scratch, "out-" + "-".join(route).replace(" ", "_"))
        stat.main(["--landed", landed, "--out", out, *route])
        return spark.read.json(out).collect()

    assert [r.competition_id for r in run("competitions")] == [9]
    assert len(run("matches", "--competition", "9", "--season", "281")) == 2
    ev = run("events", "--match", "3895302", "--stat", "pass_acc", "--player", "40724")
    assert [(r.player_id, r.total_passes) for r in ev] == [(40724, 2)]
    season = run("season", "--competition", "9", "--season", "281", "--stat", "pass_acc")
    assert {r.player_id: r.total_passes for r in season} == {40724: 3, 34870: 1}
    team = run("season-team", "--competition", "9", "--season", "281", "--stat", "players",
               "--team-name", "Bayer Leverkusen")
    assert sorted(r.name for r in team) == ["Florian Wirtz", "Granit Xhaka"]


def test_relanding_a_season_keeps_the_others(spark, scratch):
    import json

    from jsondocs import TEAM_A, WIRTZ, ev

    paths = _docs(scratch)
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    out = os.path.join(scratch, "landed_seasons")
    land_events(S.read_events(spark, paths["events"]), matches, out)
    other = os.path.join(scratch, "season282")
    os.makedirs(other)
    with open(os.path.join(other, "3895999.json"), "w") as f:
        json.dump([ev(1, "Pass", TEAM_A, WIRTZ, **{"pass": {"end_location": [1.0, 1.0]}})], f)
    land_events(S.read_events(spark, os.path.join(other, "*.json")), matches, out)
    seasons = {r.season_id: r.n for r in spark.read.parquet(out).groupBy("season_id").agg(F.count("*").alias("n")).collect()}
    assert seasons == {281: 23, 282: 1}
    # landing season 281 again replaces it, not adds to it
    land_events(S.read_events(spark, paths["events"]), matches, out)
    seasons = {r.season_id: r.n for r in spark.read.parquet(out).groupBy("season_id").agg(F.count("*").alias("n")).collect()}
    assert seasons == {281: 23, 282: 1}


def test_relanding_matches_keeps_other_seasons(spark, scratch):
    from touchline.sources.landing import land_matches

    paths = _docs(scratch)
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    out = os.path.join(scratch, "matches_landed")
    land_matches(matches, out)
    land_matches(matches.filter("season.season_id = 282"), out)
    per_season = {r.season_id: r.n for r in spark.read.parquet(out).groupBy("season_id").agg(
        F.count("*").alias("n")).collect()}
    assert per_season == {281: 2, 282: 1}
