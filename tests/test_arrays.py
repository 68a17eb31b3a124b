"""Array documents in splits of any size: the same elements as a JSON parser finds, and documents written in parts."""

from __future__ import annotations

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from touchline.schemas import EVENT_DOCUMENT_SCHEMA
from touchline.sources import arrays as R
from touchline.sources import documents as S

SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def split_size(spark):
    before = spark.conf.get(SIZE)
    yield lambda n: spark.conf.set(SIZE, str(n))
    spark.conf.set(SIZE, before)


def value(rnd: random.Random, depth: int = 0):
    kind = rnd.randint(0, 7 if depth < 3 else 4)
    if kind < 2:
        return "".join(rnd.choice(['"', "\\", "{", "}", "[", "]", ",", "a", "é", "\U0001f600", "\n", "\\\\", " ", "﻿"]) for _ in range(rnd.randint(0, 12)))
    if kind < 5:
        return rnd.choice([None, True, -1.5, 7, 10**20, ""])
    if kind == 5:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 4))]
    return {f"k{rnd.randint(0, 9)}}}{{": value(rnd, depth + 1) for _ in range(rnd.randint(0, 4))}


def scanned(spark, path, **kw):
    rows = R.scan_array_documents(spark, path, position=True, **kw).collect()
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.source_file, r.position)):
        assert r.position == len(out.setdefault(os.path.basename(r.source_file), []))
        out[os.path.basename(r.source_file)].append((r.unreadable, r.element))
    return out


@pytest.mark.parametrize("size", [16, 61, 256, 4096, 10**6])
def test_elements_at_any_split_size(spark, scratch, split_size, size):
    rnd, want = random.Random(3), {}
    for n in range(12):
        document = [value(rnd) for _ in range(rnd.choice([0, 1, 5, 30]))]
        text = json.dumps(document, ensure_ascii=bool(n % 2), indent=rnd.choice([None, 1]))
        with open(f"{scratch}/d{n}.json", "w", encoding="utf-8-sig" if n == 5 else "utf-8") as f:
            f.write(text + rnd.choice(["", "\n", " \r\n\t"]))
        if document:
            want[f"d{n}.json"] = document
    split_size(size)
    got = scanned(spark, f"{scratch}/*.json")
    assert not any(bad for rows in got.values() for bad, _ in rows)
    assert {k: [json.loads(x, strict=False) for _, x in rows] for k, rows in got.items()} == want


ODD = {
    "truncated": ('[{"a": 1}, {"b": "}, {"}, {"c": [1, {"d"', [(False, '{"a": 1}'), (False, '{"b": "}, {"}'), (True, '{"c": [1, {"d"')]),
    "truncated_behind_brace": ('[{"a": 1}, {"c": {"d": 1}', [(False, '{"a": 1}'), (True, '{"c": {"d": 1}')]),
    "truncated_string": ('[{"a": "x}]', [(True, '{"a": "x}]')]),
    "unclosed": ('[{"a": 1}, {"b": 2}', [(False, '{"a": 1}'), (True, '{"b": 2}')]),
    "object": (' {"a": [1, {"b": 2}], "c": "]"} \n', [(False, '{"a": [1, {"b": 2}], "c": "]"}')]),
    "gap": ('[{"a": 1},, {"b": 2},]', [(False, '{"a": 1}'), (True, ""), (False, '{"b": 2}'), (True, "")]),
    "trailing": ('[{"a": 1}] tail', [(False, '{"a": 1}'), (True, "tail")]),
    "text": ("no json }", [(True, "no json }")]), "empty": ("[ \n ]", []), "blank": (" \n ", []), "nothing": ("", []), "numbers": ("[1, null,\"x\"]", [(False, "1"), (False, "null"), (False, '"x"')]),
    "deep": ("[" * 40 + "]" * 40, [(False, "[" * 39 + "]" * 39)]),
}


@pytest.mark.parametrize("size", [7, 4096])
def test_documents_that_are_no_whole_array(spark, scratch, split_size, size):
    for name, (text, _) in ODD.items():
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(text)
    split_size(size)
    got = scanned(spark, f"{scratch}/*.json")
    for name, (_, want) in ODD.items():
        assert got.get(f"{name}.json", []) == want, name


def test_large_strings_and_long_backslashes(spark, scratch, split_size):
    document = [{"a": "\\" * 3001}, {"b": '"}' * 4000}, {"c": "x" * 20000}, {"d": "\\" * 3000 + '"'}]
    with open(f"{scratch}/x.json", "w") as f:
        json.dump(document, f)
    for size in (100, 1000, 10**6):
        split_size(size)
        assert [json.loads(x) for _, x in scanned(spark, f"{scratch}/x.json")["x.json"]] == document


def test_events_read_alike_with_and_without_splits(spark, scratch, split_size):
    from jsondocs import match_drift, match_full

    for match, events in ((3895302, match_full() * 30), (3895303, match_drift())):
        with open(f"{scratch}/{match}.json", "w") as f:
            json.dump(events, f, indent=1)
    whole = sorted(map(str, S.read_events(spark, f"{scratch}/*.json").collect()))
    for size in (4096, 10**7):
        split_size(size)
        assert sorted(map(str, S.read_events(spark, f"{scratch}/*.json", split=True).collect())) == whole


def document(folder: str) -> str:
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{folder}/part-*")))


def test_parts_are_one_ordered_array(spark, scratch, split_size):
    rows = spark.range(1000).select((F.lit(999) - F.col("id")).alias("id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('"}, {é'), F.col("id"))).alias("t"), (F.col("id") % 7).alias("k")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        R.write_json_array(rows, f"{scratch}/doc", ["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{scratch}/doc/part-*")) > 1  # several tasks wrote it
    want = sorted(({k: v for k, v in r.asDict().items() if v is not None} for r in rows.collect()), key=lambda r: (r["k"], r["id"]))
    assert json.loads(document(f"{scratch}/doc")) == want
    for size in (4096, 10**7):
        split_size(size)
        assert [json.loads(x) for _, x in scanned(spark, f"{scratch}/doc", folders=True)["doc"]] == want


def test_empty_single_and_equal_rows(spark, scratch):
    rows = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y"), (None, "x")], "id int, t string")
    R.write_json_array(rows, f"{scratch}/equal", ["id"])
    assert json.loads(document(f"{scratch}/equal")) == [{"t": "x"}, {"t": "x"}, {"id": 1, "t": "y"}, {"id": 1, "t": "y"}]
    R.write_json_array(rows.filter("id = 1").limit(1), f"{scratch}/one", ["id"])
    assert json.loads(document(f"{scratch}/one")) == [{"id": 1, "t": "y"}]
    R.write_json_array(rows.filter("false"), f"{scratch}/none", ["id"])
    assert json.loads(document(f"{scratch}/none")) == []


def test_reasons(spark, scratch):
    good = {"id": "a", "index": 1, "type": {"id": 30, "name": "Pass"}, "location": [1, 2.5], "minute": 3}
    cases = [
        ('{"id": tru}', "broken json"), ("7", "no object"), ("null", "no object"), ('["x"]', "no object"), ("", "no element of an array"),
        (json.dumps(good | {"index": "one"}), "field index: bigint expected, string found"),
        (json.dumps(good | {"index": 1.5}), "field index: bigint expected, decimal found"),
        (json.dumps(good | {"type": "Pass"}), "field type: struct expected, string found"),
        (json.dumps(good | {"type": {"id": {"x": 1}}}), "field type.id: bigint expected, object found"),
        (json.dumps(good | {"location": "here"}), "field location: array<double> expected, string found"),
        (json.dumps(good | {"location": [1, "x"]}), "field location: array<double> expected, array found"),
    ]
    with open(f"{scratch}/1.json", "w") as f:
        f.write("[" + ",".join([json.dumps(good)] + [x for x, _ in cases] + [json.dumps(good | {"minute": None})]) + "]")
    df = S.read_json_documents(spark, f"{scratch}/1.json", EVENT_DOCUMENT_SCHEMA, split=True)
    good_rows, bad = S.split_corrupt(df)
    assert good_rows.count() == 2 and "_corrupt_reason" not in good_rows.columns
    assert sorted((r.raw_text, r.reason) for r in bad.collect()) == sorted(cases)
