"""Operator 4, embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine ``t`` or more lie within the squared distance
``2 - 2t``. After a random rotation the coordinates are split into blocks, each
with a share of that budget in proportion to its coordinates: of every linked
pair at least one block is within its share. So each block is range-joined by
itself, on a grid whose cells are as wide as the block's radius. Its first coordinates
deal the vectors to tasks; a task goes on through the block's other coordinates, strip by
strip, and multiplies only what is left together after all of them or is few enough. Candidates
lose most false pairs to the distance over a few more coordinates; the union of the rest
is verified exactly, in double precision, in the same task. A pair counts in the first
block it fits: rotated coordinates are whole numbers, with the budgets rounded up for it, so
every task comes to the same answer.

Equal vectors are collapsed before, and tasks return a link count and one
neighbour per vector, never pairs, so the output is linear in the input. Cells
over ``CHUNK`` vectors are split into a grid of chunk pairs.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import components, landed, table

COSINE = 0.9
BLOCKS = 8
#: Vectors of one side of a task, about.
CHUNK = 32768
#: Coordinate steps of a cell number.
_STEP = 128
#: Pairs that are multiplied instead of being cut into strips once more, and pairs gathered at once.
_LEAF, _PAIRS = 1 << 20, 1 << 16
#: Rows of one multiplication.
_ROWS = 512
#: Rotated coordinates are in units of ``1 / _SCALE``, whole numbers of two bytes.
_SCALE = 32000
#: What single precision may add to a squared distance, in square units.
_SLACK = 1e-5 * _SCALE**2


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(dims)).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def most(dims: int, cosine: float) -> int:
    """The largest squared distance, in square units, of linked vectors: a rounded coordinate is off by half a unit."""
    return math.ceil((_SCALE * math.sqrt(2 - 2 * cosine + 1e-12) + math.sqrt(dims)) ** 2)


def blocks(dims: int, cosine: float) -> list[tuple[int, int, int]]:
    """``(first, last, budget)`` of each block of coordinates."""
    n = min(BLOCKS, dims)
    cuts = [dims * k // n for k in range(n + 1)]
    return [(a, b, -(-most(dims, cosine) * (b - a) // dims)) for a, b in itertools.pairwise(cuts)]


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Rows as doubles; None for what can't be linked."""
    column = column.cast(pa.list_(pa.float64()))
    flat, at = column.flatten(), 0
    values, missing = flat.to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)
    out: list[np.ndarray | None] = []
    for n, null in zip(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_pylist(), column.is_null().to_pylist(), strict=True):
        v = values[at : at + n]
        bad = null or not n or missing[at : at + n].any() or not np.isfinite(v).all() or not v.any()
        out.append(None if bad else v)
        at += n
    return out


def _prepared(kind: np.dtype):
    """Each vector's bytes as they came, its rotated coordinates, and a mark that equal directions share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _vectors(batch.column("vector"))
            marks, dims = [None if v is None else hashlib.blake2b((v / np.abs(v).max()).tobytes(), digest_size=16).digest() for v in found], [None if v is None else len(v) for v in found]
            bodies = [None if v is None else v.astype(kind).tobytes() for v in found]
            turned: list[bytes | None] = [None] * len(found)
            for d in {n for n in dims if n}:
                rows = [n for n, x in enumerate(dims) if x == d]
                whole = np.rint(_units([bodies[n] for n in rows], d, kind) @ rotation(d) * _SCALE).astype(np.int16)
                for n, t in zip(rows, whole, strict=True):
                    turned[n] = t.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(marks, pa.binary()), pa.array(dims, pa.int32()), pa.array(bodies, pa.binary()), pa.array(turned, pa.binary())],
                names=["id", "mark", "dims", "body", "turned"],
            )

    return run


def _units(bodies: list[bytes] | pd.Series, dims: int, kind: np.dtype) -> np.ndarray:
    """The vectors scaled to length 1, in double precision."""
    units = np.frombuffer(b"".join(bodies), kind).reshape(len(bodies), dims).astype(np.float64)
    units /= np.abs(units).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    units /= np.sqrt(np.einsum("ij,ij->i", units, units))[:, None]
    return units


def _turned(rows: pd.DataFrame, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows["turned"]), np.int16).reshape(len(rows), dims)


def _cells(cosine: float, axes: int):
    """The cell of each vector in each block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dims, rows in frame.groupby("dims"):
                turned = _turned(rows, dims)
                for b, (first, last, budget) in enumerate(blocks(dims, cosine)):
                    cell = np.zeros(len(rows), np.int64)
                    for k in range(min(axes, last - first)):
                        cell = cell * _STEP + np.floor(turned[:, first + k] / math.sqrt(budget)).astype(np.int64) + _STEP // 2
                    yield rows.assign(block=np.int32(b), cell=cell)

    return run


def _strips(part: np.ndarray, rows: np.ndarray, axis: int, width: float) -> dict[int, np.ndarray]:
    """``rows`` by the strip of ``axis`` that they lie in."""
    strip = np.floor(part[rows, axis] / width).astype(np.int64)
    order = np.argsort(strip, kind="stable")
    cuts = np.flatnonzero(np.diff(strip[order])) + 1
    return {int(strip[g[0]]): rows[g] for g in np.split(order, cuts)}


def _near(part: np.ndarray, square: np.ndarray, a: np.ndarray, b: np.ndarray | None, axis: int, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``a`` and ``b``, or of ``a`` with itself, within ``budget`` over all coordinates of the block.

    Both sides are cut into strips as wide as the radius; only a strip and its neighbours can
    hold pairs. These go on with the next coordinate, down to few pairs or the last one.
    """
    other = a if b is None else b
    if axis < part.shape[1] and len(a) * len(other) > _LEAF:
        width = math.sqrt(budget + _SLACK)
        left = _strips(part, a, axis, width)
        right = left if b is None else _strips(part, b, axis, width)
        for s, rows in left.items():
            for t in (s, s + 1) if b is None else (s - 1, s, s + 1):
                if t in right:
                    yield from _near(part, square, rows, None if b is None and s == t else right[t], axis + 1, budget)
        return
    for start in range(0, len(a), _ROWS):
        some = a[start : start + _ROWS]
        against = other[start:] if b is None else other
        # in place, as this is where the time goes
        gap = part[some] @ part[against].T
        gap *= -2
        gap += square[some][:, None]
        gap += square[against][None, :]
        x, y = np.divmod(np.flatnonzero(gap.ravel() <= budget + _SLACK), len(against))
        if b is None:
            x, y = x[x < y], y[x < y]
        if len(x):
            yield some[x], against[y]


def _gathered(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, about ``_PAIRS`` at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for a, b in found:
        for at in range(0, len(a), _PAIRS):
            held.append((a[at : at + _PAIRS], b[at : at + _PAIRS]))
            n += len(held[-1][0])
            if n >= _PAIRS:
                yield tuple(map(np.concatenate, zip(*held)))
                held.clear()
                n = 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _fewer(turned: np.ndarray, x: np.ndarray, y: np.ndarray, layout: list[tuple[int, int, int]], block: int, whole: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose distance over this block and the next two stays within the whole budget."""
    total = np.zeros(len(x), np.float32)
    for b in range(block, block + min(3, len(layout))):
        first, last, _ = layout[b % len(layout)]
        gap = turned[x, first:last] - turned[y, first:last]
        total += np.einsum("ij,ij->i", gap, gap)
        keep = total <= whole + _SLACK
        x, y, total = x[keep], y[keep], total[keep]
    return x, y


def _within(x: np.ndarray, y: np.ndarray, layout: list[tuple[int, int, int]], block: int) -> np.ndarray:
    """Whether ``block`` is the first in which each pair of rows is within its budget, in whole numbers."""
    square = (x.astype(np.int64) - y) ** 2
    ok = np.ones(len(x), bool)
    for b, (first, last, budget) in enumerate(layout[: block + 1]):
        inside = square[:, first:last].sum(axis=1) <= budget
        ok &= inside if b == block else ~inside
    return ok


def _joined(parents: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the sets of the pairs; a root is its set's smallest row."""
    while len(a):
        while (up := parents[parents]).sum() != parents.sum():
            parents[:] = up
        a, b = parents[a], parents[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parents, np.maximum(a, b), np.minimum(a, b))


def _compared(cosine: float, kind: np.dtype):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dims, block, _, task, i, j = key
        rows = rows.sort_values(["side", "rep"])
        units = _units(rows["body"], dims, kind)
        whole = _turned(rows, dims)
        turned = whole.astype(np.float32)
        weight, left = rows["weight"].to_numpy(), int((rows["side"] == 0).sum())
        layout = blocks(dims, cosine)
        first, last, budget = layout[block]
        part = np.ascontiguousarray(turned[:, first:last])
        square = np.einsum("ij,ij->i", part, part)
        links, parents = np.zeros(len(rows), np.int64), np.arange(len(rows))
        own, visiting = np.arange(left), np.arange(left, len(rows))
        searches = [_near(part, square, own, visiting, 0, budget)] if len(visiting) else []
        if task < 2 and i == j:  # rows of the left side are compared with each other, too
            searches.append(_near(part, square, own, None, 0, budget))
        for a, b in _gathered(itertools.chain(*searches)):
            x, y = _fewer(turned, a, b, layout, block, most(dims, cosine))
            keep = np.einsum("ij,ij->i", units[x], units[y]) >= cosine
            x, y = x[keep], y[keep]
            keep = _within(whole[x], whole[y], layout, block)
            x, y = x[keep], y[keep]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            _joined(parents, x, y)
        while (up := parents[parents]).sum() != parents.sum():
            parents = up
        rep, some = rows["rep"].to_numpy(), links > 0
        return pd.DataFrame({"a": rep[some], "b": rep[parents[some]], "links": links[some]})

    return run


def link(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = CHUNK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows with a cosine of ``cosine`` or more, equal
    vectors included; the component is the smallest id reachable by links, and
    only the vector of that id is kept. Vectors that are null, empty, zero or
    hold a null or non-finite component, and vectors of other lengths, are
    linked with nothing; a row without an id takes no part in links either and
    is kept, its component null. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    # single precision holds all that such a column has
    kind = np.dtype(np.float32 if "float" in vectors.schema[vector_col].dataType.simpleString() else np.float64)
    rows = landed(rows.mapInArrow(_prepared(kind), "id bigint, mark binary, dims int, body binary, turned binary"), "vectors")
    reps = landed(
        rows.filter("mark is not null and id is not null")
        .groupBy("dims", "mark").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("body").alias("body"), F.first("turned").alias("turned")),
        "reps",
    )
    # a coordinate spreads over about five or six cells
    axes = max(1, round(math.log(max(reps.count(), 1) / chunk, 5.5)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema)
    homes = reps.mapInPandas(_cells(cosine, axes), f"{schema}, block int, cell bigint")
    # half of the neighbours: the other half has this cell among theirs
    steps = [sum(s * _STEP**k for k, s in enumerate(d)) for d in itertools.product((-1, 0, 1), repeat=axes)]
    ahead = F.array(*(F.lit(s).cast("bigint") for s in sorted(s for s in steps if s > 0)))
    sizes = landed(homes.groupBy("dims", "block", "cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    visits = (
        sizes.select("dims", "block", F.explode(F.transform(ahead, lambda s: F.col("cell") - s)).alias("cell"), "n")
        .groupBy("dims", "block", "cell").agg(F.sum("n").alias("visitors"))
    )
    pieces = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / F.lit(chunk)).cast("int")
    tasks = sizes.join(visits, ["dims", "block", "cell"], "left").select(
        "dims", "block", F.col("cell").alias("task"), pieces(F.col("n")).alias("kx"), F.greatest(pieces(F.col("visitors")), F.lit(1)).alias("kv")
    )
    roles = landed(
        tasks.select("*", F.explode(F.concat(F.array(F.lit(0).cast("bigint")), ahead)).alias("step"))
        .select("dims", "block", (F.col("task") + F.col("step")).alias("cell"), "task", (F.col("step") == 0).alias("home"), "kx", "kv"),
        "roles",
    )
    part = lambda k: F.pmod(F.xxhash64("rep"), F.col(k)).cast("int")
    at = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    zero = F.lit(0)
    places = (
        F.when(F.col("home") & (F.col("kx") == 1), F.transform(upto(F.col("kv")), lambda j: at(0, zero, j, 0)))
        .when(
            F.col("home"),
            F.concat(
                F.transform(F.sequence(part("kx"), F.col("kx") - 1), lambda j: at(1, part("kx"), j, 0)),
                F.transform(F.filter(upto(F.col("kx")), lambda i: i < part("kx")), lambda i: at(1, i, part("kx"), 1)),
                F.transform(upto(F.col("kv")), lambda j: at(2, part("kx"), j, 0)),
            ),
        )
        .when(F.col("kx") == 1, F.array(at(0, zero, part("kv"), 1)))
        .otherwise(F.transform(upto(F.col("kx")), lambda i: at(2, i, part("kv"), 1)))
    )
    placed = homes.join(roles, ["dims", "block", "cell"]).select("dims", "block", "task", "rep", "weight", "body", "turned", F.explode(places).alias("p"))
    found = landed(
        placed.select("dims", "block", "task", "p.kind", "p.i", "p.j", "p.side", "rep", "weight", "body", "turned")
        .groupBy("dims", "block", "task", "kind", "i", "j").applyInPandas(_compared(cosine, kind), "a bigint, b bigint, links bigint"),
        "links",
    )
    groups = components(found.select("a", "b")).select(F.col("node").alias("rep"), "component")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    named = (
        reps.select("mark", "rep", "weight").join(counts, "rep", "left").join(groups, "rep", "left")
        .select("mark", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    out = rows.select("id", F.when(F.col("id").isNotNull(), F.col("mark")).alias("mark")).join(named, "mark", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def op4_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 4 over all of ``embeddings``."""
    return link(table(spark, sf_dir, "embeddings"))


QUERIES = {"op4_vector_duplicates": op4_vector_duplicates}
ORACLE_SQL = {
    "op4_vector_duplicates": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(node, other) AS (SELECT a, a FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
c AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
n AS (SELECT a AS node, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component, vec_id)::BIGINT AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.node = vec_id LEFT JOIN c ON c.node = vec_id"""
}
