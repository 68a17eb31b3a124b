"""What a scan of array documents does for each element: no sort or window over texts, one parse; batches of any size give the same rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from touchline.schemas import EVENT_DOCUMENT_SCHEMA
from touchline.sources import arrays as R
from touchline.sources import documents as S

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Text, and its rows by place: readable or not, with what stands between the cuts.
EDGES = {
    "edges": ('[﻿ {"a":1}\t, {"b":{}} ,"x" ,\n{"c":3}\n\n,é ]', ['{"a":1}', '{"b":{}}', '"x" ', '{"c":3}', "é"]),
    "empty": ('[ ][{"x":1}][﻿][1]', [("", True), '{"x":1}', ("", True), ("", True), "1"]),
    "large": (json.dumps([{"a": {"b": [{}, {"c": "}" * n}]}} for n in range(40)], indent=1), None),
}


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _rows(spark, path) -> list:
    return sorted(R.scan_array_documents(spark, path, position=True).collect(), key=lambda r: r.position)


def test_places_need_no_window_over_the_texts(spark, scratch):
    with open(f"{scratch}/1.json", "w") as f:
        json.dump([{"id": "a"}, {"id": "b"}], f)
    plan = _plan(R.scan_array_documents(spark, f"{scratch}/1.json", position=True))
    assert "Window" not in plan and "Sort" not in plan


@pytest.mark.parametrize("sent", [0, 100_000])
@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_rows_do_not_depend_on_batches(spark, scratch, monkeypatch, batch, sent):
    before = spark.conf.get(BATCH)
    monkeypatch.setattr(R, "SENT_SPLITS", sent)
    spark.conf.set(BATCH, batch)
    try:
        for name, (text, want) in EDGES.items():
            with open(f"{scratch}/{name}.json", "w", encoding="utf-8") as f:
                f.write(text)
            got = _rows(spark, f"{scratch}/{name}.json")
            assert [r.position for r in got] == list(range(len(got)))
            if want is None:
                assert [json.loads(r.element) for r in got] == json.loads(text)
            else:
                assert [(r.element, r.unreadable) for r in got] == [w if isinstance(w, tuple) else (w, False) for w in want]
    finally:
        spark.conf.set(BATCH, before)


def test_elements_are_parsed_once(spark, scratch):
    """Keeping good or bad rows parses no element again, and their reasons parse it once, however many fields are checked."""
    with open(f"{scratch}/1.json", "w") as f:
        json.dump([{"id": "a", "minute": 3}, {"id": "b", "minute": "late"}, {"id": "c", "team": {"id": [1]}}], f)
    good, bad = S.split_corrupt(S.read_json_documents(spark, f"{scratch}/1.json", EVENT_DOCUMENT_SCHEMA, split=True))
    for df in (good, bad):
        assert _plan(df).count("from_json(") == 1
    assert str(S.misfit(F.col("element"), EVENT_DOCUMENT_SCHEMA)).count("try_parse_json") == 1
    assert [(r.id, r.minute) for r in good.collect()] == [("a", 3)]
    assert sorted(r.reason for r in bad.collect()) == ["field minute: bigint expected, string found", "field team.id: bigint expected, array found"]
