"""Operator 2, exact top-k inner product search by norm-bucketed retrieval.

Vectors are grouped into buckets of similar length, and buckets into blocks of
bounded size. A first pass over one block of long vectors gives every query a
score that its k-th best reaches, its threshold. A query then visits only the
buckets whose longest vector can reach that. In a block the threshold becomes a
*local cosine threshold*, the cosine that its longest vector needs: if it is
high, the query's largest coordinates bound those of every result (coordinate
pruning); if it is low, only vectors that are too short are left out (length
pruning). The products of what remains are verified exactly.

Buckets are quantiles of the length, as many as there are blocks up to ``MOST_BUCKETS``, so
that length pruning keeps up with the size of the table. Queries are dealt into groups, and
a vector is sent to those groups only that visit its block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import landed, table

SCALE = 1024
K = 10
#: Length buckets at least and at most, and vectors and queries of a block, about.
BUCKETS, MOST_BUCKETS, BLOCK, QUERIES_BLOCK = 16, 4096, 8192, 4096
#: A block of vectors, and the group of queries that it meets.
NAMES = ["dims", "bucket", "part", "group"]
#: Coordinate pruning pays from this local cosine threshold on, with so many coordinates.
HIGH, FOCUS = 0.3, 6
#: Room for rounding in lengths and cosines.
_ROOM = 1 + 1e-9
_EXACT = float(1 << 53)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as whole numbers in doubles, with their length."""
    for batch in batches:
        column = batch.column("vector").cast(pa.list_(pa.float64()))
        rows, data, dims, norms = [], [], [], []
        for n, v in enumerate(column):
            v = np.array([], float) if not v.is_valid else v.values.to_numpy(zero_copy_only=False)
            if not column[n].is_valid or column[n].values.null_count or not np.isfinite(v).all():
                continue
            v = np.floor(np.clip(v, -1e150, 1e150) * SCALE)
            rows.append(n), data.append(v.tobytes()), dims.append(len(v)), norms.append(math.sqrt(float(v @ v)))
        ids = batch.column("id").take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(data, pa.binary()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64())], names=["id", "v", "dims", "norm"])


def _matrix(rows: pd.DataFrame, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows["v"]), np.float64).reshape(len(rows), dims)


def _products(some: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Inner products as whole numbers: doubles are exact up to 2^53, beyond that Python's integers are."""
    if most < _EXACT:
        return (some @ query).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, query, strict=True)) for row in some]
    return np.array([min(max(x, _LEAST), _MOST) for x in exact], np.int64)


def _candidates(units: np.ndarray, norms: np.ndarray, query: np.ndarray, length: float, threshold: float) -> np.ndarray:
    """Rows, longest first, that may reach the threshold."""
    reach = int(np.searchsorted(-norms, -threshold / length / _ROOM, side="right"))  # length pruning
    local = threshold / (length * norms[0]) / _ROOM
    if local < HIGH or not reach:
        return np.arange(reach)
    unit = query / length
    rows = np.arange(reach)
    for f in np.argsort(-np.abs(unit))[:FOCUS]:
        # coordinate pruning: a result's angle to the axis differs from the query's by the local angle at most
        spread = math.sqrt(max(0.0, 1 - local**2) * max(0.0, 1 - unit[f] ** 2))
        low = unit[f] * local - spread if unit[f] > -local else -1.0
        high = unit[f] * local + spread if unit[f] < local else 1.0
        values = units[rows, f]
        rows = rows[(values >= low - 1e-9) & (values <= high + 1e-9)]
    return rows


def _searched(k: int, seed: bool):
    """Best candidates of each query in one block; for ``seed`` only the k-th score."""

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("norm", ascending=False)
            data, norms, ids = _matrix(vectors, key[0]), vectors["norm"].to_numpy(), vectors["id"].to_numpy()
            units = data / np.maximum(norms, 1e-300)[:, None]
            for qid, query, length, threshold in zip(queries["id"], _matrix(queries, key[0]), queries["norm"], queries["threshold"], strict=True):
                rows = np.arange(len(ids))
                if threshold > 0 and length > 0 and norms[0] > 0:
                    rows = _candidates(units, norms, query, length, threshold)
                rows = rows[ids[rows] != qid]
                scores = _products(data[rows], query, length * norms[0] * _ROOM)
                if not np.isnan(threshold):
                    keep = scores >= threshold
                    rows, scores = rows[keep], scores[keep]
                if len(scores) > k:  # ties with the k-th score stay for the choice by id
                    keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    rows, scores = rows[keep], scores[keep]
                best = np.lexsort((ids[rows], -scores))[:k]
                if seed and len(best) == k:
                    out.append((qid, int(ids[rows[best[-1]]]), int(scores[best[-1]])))
                elif not seed:
                    out += zip([qid] * len(best), ids[rows[best]].tolist(), scores[best].tolist(), strict=True)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def search(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, queries_block: int = QUERIES_BLOCK) -> DataFrame:
    """The ``k`` best candidates of each query row: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on the column ``id``; every row with another id
    is a candidate. A score is the inner product of the quantised vectors, kept
    within the range of a long; ties go to the smaller id. Rows whose vector is
    null or holds a null or non-finite component take no part, nor do rows
    without an id; only vectors of the same length meet. Equal rows count once;
    different vectors of one query id share its list. An empty table, or one
    without queries, gives no rows.
    """
    placed, visits = planned(vectors, is_query, k, id_col, vector_col, block, queries_block)
    best = _met(placed, visits, k, False)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _bucketed(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with the ``bucket`` of their length, the longest vectors in bucket 0."""
    n = min(MOST_BUCKETS, max(BUCKETS, math.ceil(rows.count() / block)))
    found = rows.agg(F.percentile_approx("norm", [(i + 1) / n for i in range(n - 1)], 100 * n).alias("cuts")).first()["cuts"] or []
    cuts = np.array(sorted(set(found)), float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = batch.column("norm").to_numpy()
            yield batch.append_column("bucket", pa.array((len(cuts) - np.searchsorted(cuts, norms)).astype(np.int32)))

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", bucket int")


def sent(candidates: DataFrame, visits: DataFrame) -> DataFrame:
    """A copy of each candidate for each group of queries that visits its block."""
    groups = landed(visits.select(*NAMES).distinct(), "groups")
    return candidates.select("dims", "bucket", "part", "id", "v", "norm").join(groups, NAMES[:3])


def _met(candidates: DataFrame, visits: DataFrame, k: int, seed: bool) -> DataFrame:
    left = sent(candidates, visits).groupBy(*NAMES)
    right = visits.select(*(F.col(c).alias(c) for c in (*NAMES, "id", "v", "norm", "threshold"))).groupBy(*NAMES)
    return left.cogroup(right).applyInPandas(_searched(k, seed), "query_id bigint, vec_id bigint, score bigint")


def planned(vectors: DataFrame, is_query, k: int, id_col: str, vector_col: str, block: int, queries_block: int) -> tuple[DataFrame, DataFrame]:
    """The vectors in their blocks, and the queries once for each block that they visit."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector")).filter("id is not null")
    rows = landed(rows.mapInArrow(_quantised, "id bigint, v binary, dims int, norm double").distinct(), "quantised")
    placed = _bucketed(rows, block)
    sizes = landed(
        placed.groupBy("dims", "bucket").agg(F.max("norm").alias("longest"), F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts")), "buckets"
    )
    placed = placed.join(sizes, ["dims", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    asked = landed(rows.filter(is_query), "queries")
    groups = max(1, math.ceil(asked.count() / queries_block))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int"))

    # the first pass: one block of the longest bucket of each dimension
    first = sizes.groupBy("dims").agg(F.min("bucket").alias("bucket")).withColumn("part", F.lit(0))
    seeds = _met(placed.join(first, ["dims", "bucket", "part"], "left_semi"), asked.join(first, "dims").withColumn("threshold", F.lit(float("nan"))), k, True)
    thresholds = landed(seeds.groupBy(F.col("query_id").alias("id")).agg(F.expr("min(score) - abs(min(score)) * 1e-12D").alias("threshold")), "thresholds")
    queries = landed(asked.join(thresholds, "id", "left").withColumn("threshold", F.coalesce("threshold", F.lit(float("nan")))), "queries")
    visits = (
        queries.join(sizes, "dims").filter(F.isnan("threshold") | (F.col("norm") * F.col("longest") * _ROOM >= F.col("threshold")))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    return placed, visits


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 2: every hundredth id of ``embeddings`` against all rows."""
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {"op2_top_k": op2_top_k}
ORACLE_SQL = {
    "op2_top_k": f"""
WITH v AS (
  SELECT DISTINCT vec_id, [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}"""
}
