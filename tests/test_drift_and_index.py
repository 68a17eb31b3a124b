"""Drifting schemas, the nested field test, and the index of landed matches."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsondocs import write_documents
from touchline.operators import aggregations as A
from touchline.plans import catalog
from touchline.plans.inspect import executed_plan
from touchline.plans.registry import LATER_SEASON, queries
from touchline.schemas import EVENT_SCHEMA
from touchline.session import remove_scratch, scratch_folder
from touchline.sources import documents as S
from touchline.sources import drift as DR
from touchline.sources.landing import land_events, land_matches, read_index
from touchline.sources.season import match_partitions, season_events

SF = "/root/testdata/sf0.001"


def write(folder: str, **documents) -> str:
    for name, elements in documents.items():
        with open(f"{folder}/{name}.json", "w") as f:
            json.dump(elements, f)
    return f"{folder}/*.json"


# --- H3 ----------------------------------------------------------------------

DOCUMENTS = {
    "whole": [{"id": 1, "v": 3, "o": {"a": 1, "deep": {"x": 1}}, "list": [1, 2]}],
    "fraction": [{"id": 2, "v": 3.5, "o": {"b": "t", "deep": {"y": True}}, "list": [1.5]}],
    "other": [{"id": 3, "o": "text", "list": [], "extra": None}, {"id": 10**25}],
}


def test_documents_merge_into_one_schema(spark, scratch):
    df = DR.read_drifting(spark, write(scratch, **{k: v for k, v in DOCUMENTS.items() if k != "other"}))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds == {"id": "bigint", "v": "double", "o": "struct<a:bigint,b:string,deep:struct<x:bigint,y:boolean>>", "list": "array<double>", "source_file": "string"}
    rows = {r.id: r for r in df.collect()}
    assert (rows[1].v, rows[1].o.a, rows[1].o.b, rows[1].o.deep.x, rows[1].o.deep.y, rows[1].list) == (3.0, 1, None, 1, None, [1.0, 2.0])
    assert (rows[2].v, rows[2].o.a, rows[2].o.b, rows[2].o.deep.y, rows[2].list) == (3.5, None, "t", True, [1.5])


def test_conflicting_kinds_are_text(spark, scratch):
    df = DR.read_drifting(spark, write(scratch, **DOCUMENTS))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds["o"] == "string" and kinds["id"] == "double" and kinds["extra"] == "string"
    assert {json.dumps(json.loads(r.o)) if r.o.startswith("{") else r.o for r in df.filter("o is not null").collect()} == {
        json.dumps(DOCUMENTS["whole"][0]["o"]), json.dumps(DOCUMENTS["fraction"][0]["o"]), "text"}
    schemas = {os.path.basename(r.source_file): r.schema for r in DR.document_schemas(S.scan_array_documents(spark, f"{scratch}/*.json")).collect()}
    assert set(schemas) == {"whole.json", "fraction.json", "other.json"} and "DECIMAL" in schemas["fraction.json"]


def test_field_names_that_look_like_types(spark, scratch):
    element = {"VARIANT": 1, "OBJECT<": {"VOID": "x", "a`b": 2.5}, "DECIMAL(3,1)": "d", "a: b": None}
    df = DR.read_drifting(spark, write(scratch, odd=[element]))
    assert {k for k in df.columns if k != "source_file"} == set(element)
    row = df.first()
    assert row["VARIANT"] == 1 and row["OBJECT<"]["VOID"] == "x" and row["OBJECT<"]["a`b"] == 2.5


def test_no_objects_and_no_documents(spark, scratch):
    df = DR.read_drifting(spark, write(scratch, none=[], numbers=[1, None]))
    assert df.columns == ["source_file"] and df.count() == 2


def test_union_of_loaded_frames(spark):
    frames = [
        spark.sql("select 1 as id, named_struct('a', 1, 'n', named_struct('x', 1)) as o, array(1) as l, 5 as v"),
        spark.sql("select 2L as id, named_struct('b', 'q', 'n', named_struct('x', 2.5D, 'y', true)) as o, array(2.5D) as l, named_struct('z', 1) as v"),
        spark.sql("select 3L as id, null as o, 'only' as w"),
    ]
    out = DR.drift_union(frames)
    assert out.schema.simpleString() == "struct<id:bigint,o:struct<a:int,n:struct<x:double,y:boolean>,b:string>,l:array<double>,v:string,w:string>"
    rows = {r.id: r.asDict(recursive=True) for r in out.collect()}
    assert rows[1] == {"id": 1, "o": {"a": 1, "n": {"x": 1.0, "y": None}, "b": None}, "l": [1.0], "v": "5", "w": None}
    assert rows[2] == {"id": 2, "o": {"a": None, "n": {"x": 2.5, "y": True}, "b": "q"}, "l": [2.5], "v": '{"z":1}', "w": None}
    assert rows[3] == {"id": 3, "o": None, "l": None, "v": None, "w": "only"}


def test_union_agrees_with_union_by_name(spark):
    a = spark.sql("select 1L as id, named_struct('x', 1L) as s")
    b = spark.sql("select named_struct('x', 2.5D, 'y', 'q') as s, 'w' as t, 2L as id")
    plain = a.unionByName(b, allowMissingColumns=True)
    assert sorted(map(str, (r.asDict(True) for r in DR.drift_union([a, b]).collect()))) == sorted(map(str, (r.asDict(True) for r in plain.collect())))


# --- H1 ----------------------------------------------------------------------

def test_nested_field_exists():
    schema = T.StructType.fromDDL("a struct<b: int, c: struct<d: int, e: struct<f: int>>>, g int, h array<struct<i: int>>")
    found = {(p, n) for p in "abgh" for n in "bcdefgi" if A.nested_field_exists(schema, p, n)}
    assert found == {("a", "b"), ("a", "c"), ("a", "d"), ("a", "e")}  # itself or one object deeper, no arrays


def test_columns_follow_the_schema_without_a_job(spark, scratch):
    paths = write_documents(scratch)
    events = DR.read_drifting(spark, paths["events"].replace("*", "3895302")).withColumn("match_id", F.lit(1))
    blocks = A.blocks(events, by_schema=True, sort=False)
    assert blocks.columns == ["team_name", "team_id", "player_id", "player_name", "total_blocks", "standard_blocks", "standard_block_ratio", "deflection_blocks", "deflection_block_ratio"]
    assert [tuple(r)[4:] for r in blocks.collect()] == [(2, 1, 50.0, 1, 50.0)]
    assert A.fouls_won(events, by_schema=True, sort=False).columns[4:] == ["total_fouls_won", "standard_fouls", "standard_foul_ratio", "advantage_fouls", "advantage_foul_ratio"]
    committed = A.fouls_committed(events, by_schema=True, sort=False).columns
    assert "card_fouls" in committed and "dive_fouls" in committed and "penalty_fouls" not in committed
    # all fields there: all columns; no detail object at all: only the fixed ones, every event a standard one
    whole = spark.createDataFrame([], EVENT_SCHEMA)
    assert A.blocks(whole, by_schema=True, sort=False).columns == A.blocks(whole, sort=False).columns
    bare = A.blocks(events.drop("block"), by_schema=True, sort=False)
    assert [tuple(r)[4:] for r in bare.collect()] == [(2, 2, 100.0)]


# --- S5, S6 ------------------------------------------------------------------

@pytest.fixture()
def landed(spark, scratch):
    paths = write_documents(f"{scratch}/docs")
    matches = S.split_corrupt(S.read_matches(spark, paths["matches"]))[0]
    land_matches(matches.drop("source_file"), f"{scratch}/matches")
    land_events(S.read_events(spark, paths["events"]), spark.read.parquet(f"{scratch}/matches"), f"{scratch}/events")
    events = spark.read.schema(f"{EVENT_SCHEMA.toDDL()}, competition_id bigint, season_id bigint").parquet(f"{scratch}/events")
    return events, matches.drop("source_file"), f"{scratch}/events", paths


def relisted(matches, match_id: int, season: int):
    moved = F.struct(F.lit(season).cast("bigint").alias("season_id"), F.lit("moved").alias("season_name"))
    return matches.withColumn("season", F.when(F.col("match_id") == match_id, moved).otherwise(F.col("season")))


def ids(df):
    return sorted({r.match_id for r in df.select("match_id").collect()})


def test_a_relisted_match_is_found_where_it_was_landed(spark, landed):
    events, matches, path, _ = landed
    index = read_index(spark, path)
    assert sorted(map(tuple, index.collect())) == [(3895302, 9, 281), (3895303, 9, 281)]
    assert ids(season_events(events, matches, 9, 281, index)) == [3895302, 3895303]
    later = relisted(matches, 3895303, 300)
    for given in (index, None):
        assert ids(season_events(events, later, 9, 281, given)) == [3895302]
        assert ids(season_events(events, later, 9, 300, given)) == [3895303]
    assert catalog.season_stat(events, later, 9, 300, "shot", index=index).count() == 1


def test_the_index_follows_landings(spark, landed):
    events, matches, path, paths = landed
    land_events(S.read_events(spark, paths["events"].replace("*", "3895303")), relisted(matches, 3895303, 300), path)
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, read_index(spark, path).collect())) == [(3895302, 9, 281), (3895303, 9, 300)]
    again = spark.read.schema(events.schema).parquet(path)
    assert sorted(map(tuple, match_partitions(again).collect())) == [(3895302, 9, 281), (3895303, 9, 300)]


def test_events_of_no_listed_season_are_found_through_the_index(spark, landed, scratch):
    events, matches, _, _ = landed
    loose = events.withColumns({c: F.when(F.col("match_id") == 3895302, F.col(c)) for c in ("competition_id", "season_id")})
    loose.write.partitionBy("competition_id", "season_id").parquet(f"{scratch}/loose")
    read = spark.read.schema(events.schema).parquet(f"{scratch}/loose")
    assert ids(season_events(read, matches, 9, 281, match_partitions(read))) == [3895302, 3895303]


def test_the_scan_is_pruned_when_it_runs(spark):
    for name in ("season_events", "season_events_relisted"):
        df = queries()[name](spark, SF)
        assert "dynamicpruningexpression" in executed_plan(df).lower(), name
        assert df.count() > 0
    assert LATER_SEASON[1] != 281


def test_scratch_folders_go_together(spark):
    path = scratch_folder(spark, "x")
    spark.range(3).write.parquet(path)
    remove_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
