"""Operators 2 and 4 against brute force, with vectors of every odd kind."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from touchline.llm import topk, vector_dups

ODD = [None, [], [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [1.0, 2.1], [3.0]]


def _frame(spark, vectors):
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, vectors[0]), (None, None)]
    rows += rows[:10]  # repeated rows
    np.random.RandomState(3).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({c: F.lit(None).cast("string") for c in ("id", "v", "dims", "norm", "rep", "score", "label")})
    return rows, df


def _floats(rows):
    return [list(map(float, np.float32(x))) for x in rows]


@pytest.mark.parametrize("block,queries", [(8192, 4096), (64, 16)])
def test_top_k(spark, block, queries):
    r = np.random.RandomState(0)
    x = [r.normal(size=16) * r.choice([0.01, 0.1, 1, 1, 3]) for _ in range(300)]
    x += [x[100] + r.normal(size=16) * 0.02 for _ in range(15)] + [x[5]] * 15 + [np.zeros(16)] * 12 + [np.ones(16) * 1e30, np.ones(16) * 3e6, -np.ones(16) * 3e6]
    rows, df = _frame(spark, _floats(x) + ODD)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, F.col("id") % 7 == 0, block=block, queries_block=queries).collect())
    ok = {i: [math.floor(1024 * c) for c in v] for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)}
    want = []
    for q in (q for q in ok if q % 7 == 0):
        scores = sorted((-min(max(sum(a * b for a, b in zip(ok[q], v)), -(2**63)), 2**63 - 1), c) for c, v in ok.items() if c != q and len(v) == len(ok[q]))
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:10])]
    assert got == sorted(want)


def test_vectors_go_to_the_groups_that_visit_them_only(spark):
    """Long and short vectors, so that most blocks are out of reach: copies are counted."""
    r = np.random.RandomState(2)
    x = np.concatenate([r.normal(size=(300, 16)) * s for s in (10, 1, 0.1, 0.01)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    placed, visits = topk.planned(df, F.col("id") % 5 == 0, 10, "vec_id", "embedding", 64, 16)
    groups = visits.agg(F.max("group")).first()[0] + 1
    assert groups >= 10
    copies, visited = topk.sent(placed, visits).count(), visits.select(*topk.NAMES).distinct().count()
    blocks = placed.select(*topk.NAMES[:3]).distinct().count()
    assert visited < 0.6 * blocks * groups
    assert copies <= visited * 128 and copies < 0.6 * len(x) * groups
    # buckets follow the size of the table, and hold vectors of near lengths
    assert placed.select("bucket").distinct().count() >= len(x) / 64 * 0.9


def test_repeated_rows_count_once_here_and_in_sql(spark, tmp_path):
    import duckdb

    rows = [(i, [float(i % 7), 1.0, -0.5 * i]) for i in range(210)]
    spark.createDataFrame(rows + rows[::3] + rows[:1] * 4, "vec_id bigint, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(topk.ORACLE_SQL["op2_top_k"]).fetchall()
    assert sorted(map(tuple, topk.op2_top_k(spark, str(tmp_path)).collect())) == sorted(want) and len(want) == 30


@pytest.mark.parametrize("chunk", [16384, 24])
def test_links(spark, chunk):
    r = np.random.RandomState(1)
    x = []
    for _ in range(25):
        base = r.normal(size=16)
        x += [base + r.normal(size=16) * r.choice([0.1, 0.3, 0.36]) for _ in range(r.choice([1, 2, 5, 25]))]
    x += [r.normal(size=16) for _ in range(60)] + x[:20] + [x[0] * 2] * 10
    rows, df = _frame(spark, _floats(x) + ODD)
    got = {}
    for row in vector_dups.link(df, chunk=chunk).collect():
        if row["vec_id"] is None:
            assert (row["n_links"], row["component_id"], row["kept"]) == (0, None, True)
        else:
            assert got.setdefault(row["vec_id"], row) == row
    valid = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    links, up = dict.fromkeys((i for i, _ in valid), 0), {i: i for i, _ in valid}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a) in enumerate(valid):
        for j, b in valid[:n]:
            if len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.9:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    # a repeated row was counted with each of its twins' links
    times = {i: sum(1 for k, _ in valid if k == i) for i in links}
    for i, row in got.items():
        root = find(i) if i in up else i
        assert (row["n_links"] * times.get(i, 1), row["component_id"], row["kept"]) == (links.get(i, 0), root, root == i)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.search(df, F.col("id") % 100 == 0).count() == 0
    assert vector_dups.link(df).count() == 0


def test_blocks_share_the_budget():
    for dims in (1, 3, 8, 13, 64):
        layout = vector_dups.blocks(dims, 0.9)
        assert layout[0][0] == 0 and layout[-1][1] == dims
        assert sum(b for _, _, b in layout) / vector_dups._SCALE**2 == pytest.approx(0.2, abs=1e-3)
        assert sum(b for _, _, b in layout) >= vector_dups.most(dims, 0.9) >= 0.2 * vector_dups._SCALE**2
        q = vector_dups.rotation(dims)
        assert np.allclose(q @ q.T, np.eye(dims))


def test_block_search_equals_all_pairs():
    """Strips over all coordinates of a block find exactly the pairs within its budget."""
    r = np.random.RandomState(4)
    whole = np.rint(r.normal(size=(3000, 8)) * 0.1 * vector_dups._SCALE)
    whole[:500] = whole[500:1000] + np.rint(r.normal(size=(500, 8)) * 400)
    part = whole.astype(np.float32)
    square, budget = np.einsum("ij,ij->i", part, part), vector_dups.blocks(64, 0.9)[0][2]
    exact = ((whole[:, None, :] - whole[None, :, :]) ** 2).sum(axis=2)

    def pairs(a, b):
        found = [np.stack(p, 1) for p in vector_dups._near(part, square, a, b, 0, budget)]
        out = np.sort(np.concatenate(found), axis=1)
        assert len(np.unique(out, axis=0)) == len(out)
        return {(x, y) for x, y in out.tolist() if exact[x, y] <= budget}

    everyone, half = np.arange(3000), np.arange(1500)
    assert pairs(everyone, None) == {(x, y) for x, y in np.argwhere(exact <= budget).tolist() if x < y}
    assert pairs(half, half + 1500) == {(x, y) for x, y in np.argwhere(exact <= budget).tolist() if x < 1500 <= y}


def test_linked_vectors_are_within_a_block():
    """The pigeonhole holds in whole numbers: some block of every linked pair is within its share."""
    r = np.random.RandomState(6)
    for dims in (3, 16, 64):
        x = r.normal(size=(4000, dims))
        y = x + r.normal(size=x.shape) * np.linalg.norm(x, axis=1, keepdims=True) / np.sqrt(dims) * 0.5
        units = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y)]
        linked = np.einsum("ij,ij->i", *units) >= 0.9
        a, b = (np.rint(u[linked] @ vector_dups.rotation(dims) * vector_dups._SCALE) for u in units)
        assert linked.sum() > 500 and linked.sum() < 4000
        inside = [((a - b)[:, f:l] ** 2).sum(axis=1) <= budget for f, l, budget in vector_dups.blocks(dims, 0.9)]
        assert np.any(inside, axis=0).all()
