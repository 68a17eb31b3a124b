"""Streaming landing and running player totals over arriving documents."""

from __future__ import annotations

import json
import os

from jsondocs import match_drift, match_full, write_documents
from touchline.operators import team as TM
from touchline.sources import documents as S
from touchline.streaming.ingest import (
    read_event_stream,
    read_player_totals,
    start_landing,
    start_player_totals,
)


def test_stream_lands_documents_and_quarantines(spark, scratch):
    paths = write_documents(os.path.join(scratch, "docs"))
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]).cache())[0]
    stream = read_event_stream(spark, os.path.join(scratch, "docs", "events"))
    out, q = os.path.join(scratch, "landed"), os.path.join(scratch, "quarantine")
    land, quarantine = start_landing(stream, matches, out, q,
                                     checkpoint=os.path.join(scratch, "ckpt"), available_now=True)
    land.awaitTermination(120)
    quarantine.awaitTermination(120)
    landed = spark.read.parquet(out)
    assert landed.count() == 23
    assert {r.season_id for r in landed.select("season_id").distinct().collect()} == {281}
    bad = spark.read.json(q).collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("3895304.json")
    assert bad[0].raw_text.startswith("[")


def test_running_totals_follow_new_documents(spark, scratch):
    ev_dir, totals = os.path.join(scratch, "events"), os.path.join(scratch, "totals")
    os.makedirs(ev_dir)
    with open(os.path.join(ev_dir, "3895302.json"), "w") as f:
        json.dump(match_full(), f)
    stream = read_event_stream(spark, ev_dir)
    ckpt = os.path.join(scratch, "ckpt")
    q = start_player_totals(stream, "totals_a", totals, checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    first = {r.player_id: r for r in read_player_totals(spark, totals).collect()}
    assert first[40724].total_passes == 2 and first[40724].goal == 1

    # a second match arrives; the restarted query picks up only the new file
    with open(os.path.join(ev_dir, "3895303.json"), "w") as f:
        json.dump(match_drift(), f)
    q = start_player_totals(read_event_stream(spark, ev_dir), "totals_b", totals, checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    streamed = {r.player_id: r.asDict() for r in read_player_totals(spark, totals).collect()}
    assert streamed[40724]["total_passes"] == 3 and streamed[40724]["pass_accuracy"] == 67.0

    batch_events = S.split_corrupt(S.read_events(spark, os.path.join(ev_dir, "*.json")).cache())[0]
    batch = TM.all_player_stats(batch_events, sort=False)
    for r in batch.collect():
        s = streamed[r.player_id]
        for c in ("total_passes", "accurate_passes", "pass_accuracy", "total_shots", "goal",
                  "total_blocks", "deflection_blocks", "total_time_with_ball", "ball_recovery_ratio"):
            assert s[c] == r[c], (r.player_id, c)


def test_totals_accumulate_over_micro_batches(spark, scratch):
    """One document per trigger: the running state adds batches up exactly."""
    ev_dir, totals = os.path.join(scratch, "events"), os.path.join(scratch, "totals")
    os.makedirs(ev_dir)
    for mid, docs in ((3895302, match_full()), (3895303, match_drift())):
        with open(os.path.join(ev_dir, f"{mid}.json"), "w") as f:
            json.dump(docs, f)
    stream = read_event_stream(spark, ev_dir, max_files_per_trigger=1)
    q = start_player_totals(stream, "totals_c", totals, checkpoint=os.path.join(scratch, "ckpt"), available_now=True)
    q.awaitTermination(120)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2  # two micro-batches
    rows = {r.player_id: r for r in read_player_totals(spark, totals).collect()}
    assert rows[40724].total_passes == 3 and rows[40724].total_time_with_ball == round(19.75 / 60, 2)
    assert rows[40724].blocked_or_saved_by_goalkeeper == 1  # the Saved shot of the second match
