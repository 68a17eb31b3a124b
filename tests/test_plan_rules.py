"""Scale rules checked on the physical plan of every registered query.

* no cross product, no Python UDF, no exchange to a single partition;
* every shuffle carries pre-aggregated rows: its input is a partial
  aggregation, a partial window group limit, or the output of a final
  aggregation (already one row per key);
* every broadcast is of a local constant table (the heatmap kernel).
"""

from __future__ import annotations

import json

import pytest

from conftest import SF_SMALL
from touchline.plans.registry import queries

PRE_AGGREGATED = {"HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit"}


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _walk(node):
    yield node
    for c in _children(node):
        yield from _walk(c)


def _through(node):
    """Skip nodes that only pass rows on (projections, filters, codegen)."""
    while node.nodeName() in ("Project", "Filter", "WholeStageCodegen", "InputAdapter", "ColumnarToRow"):
        node = _children(node)[0]
    return node


def _initial_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.inputPlan()
    return plan


@pytest.mark.parametrize("key", sorted(queries()))
def test_plan_follows_scale_rules(spark, key):
    plan = _initial_plan(queries()[key](spark, SF_SMALL))
    for node in _walk(plan):
        name = node.nodeName()
        assert name not in ("CartesianProduct", "BroadcastNestedLoopJoin"), name
        assert "EvalPython" not in name, name
        if name == "Exchange":
            desc = node.toString()
            assert "SinglePartition" not in desc, desc[:200]
            if "hashpartitioning" in desc:
                child = _through(_children(node)[0])
                assert child.nodeName() in PRE_AGGREGATED, (key, child.nodeName())
        if name == "BroadcastExchange":
            child = _through(_children(node)[0])
            assert child.nodeName() == "LocalTableScan", (key, child.nodeName())


def test_rules_catch_a_raw_shuffle(spark, events_small):
    """The checker itself: shuffling raw rows before aggregating is flagged."""
    bad = events_small.repartition("player").groupBy("player").count()
    plan = _initial_plan(bad)
    exchanges = [n for n in _walk(plan) if n.nodeName() == "Exchange" and "hashpartitioning" in n.toString()]
    assert exchanges
    assert any(_through(_children(n)[0]).nodeName() not in PRE_AGGREGATED for n in exchanges)


@pytest.mark.parametrize("key", sorted(set(queries()) - {"event_documents", "match_documents", "competition_documents"}))  # these read JSON text
def test_every_scan_reads_a_pruned_schema(spark, key):
    """Column pruning reaches the Parquet reader: no registered query reads
    every top-level field of the landed events (22), and none reads every
    leaf of a nested struct it only tests one field of."""
    from touchline.sources.derived import LANDED_EVENTS_SCHEMA

    plan = _initial_plan(queries()[key](spark, SF_SMALL))
    scans = [n for n in _walk(plan) if n.nodeName().startswith("Scan parquet")]
    assert scans, key
    full = len(LANDED_EVENTS_SCHEMA.fields)
    for scan in scans:
        required = scan.requiredSchema()
        n = required.size()
        assert n < full, (key, n)
        assert "tactics" not in required.simpleString() or key in ("lineup", "all_player_stats",
                                                                    "team_match_stats", "team_match_stats_by_name",
                                                                    "entry_season_team_all")


def test_event_documents_are_bounded(spark, monkeypatch):
    """A match of many events has several documents, none with more than its share, and no event is lost."""
    from glob import glob

    from touchline.plans import documents, registry
    from touchline.session import checkpoint_dir

    monkeypatch.setattr(documents, "DOCUMENT_EVENTS", 40)
    before = set(glob(f"{checkpoint_dir(spark).removeprefix('file:')}/scratch/*/documents-*"))
    got = documents.event_documents(spark, SF_SMALL)
    (path,) = set(glob(f"{checkpoint_dir(spark).removeprefix('file:')}/scratch/*/documents-*")) - before
    sizes = {}
    for name in glob(f"{path}/match_id=*/part-*"):
        with open(name) as f:
            sizes.setdefault(name.split("/")[-2], []).append(len(json.loads(f.read())))
    assert sizes and max(map(max, sizes.values())) <= 40 and max(map(len, sizes.values())) > 1
    want = documents.flat(registry._ev(spark, SF_SMALL))
    assert got.count() == want.count() == sum(map(sum, sizes.values()))
    assert got.exceptAll(want).isEmpty()
