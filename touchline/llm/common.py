"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_folder

#: Bytes of text that one step inside a task handles at once.
BATCH_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that the driver and all executors share, removed with the application's others."""
    return scratch_folder(spark, name)


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to shared storage as Parquet and read back.

    Cuts the lineage, survives lost executors, and gives the planner the true
    size of the table, so that Spark's own size check decides what it broadcasts.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_bytes(batches: Iterable[pa.RecordBatch], text: str, most: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into runs of whole rows of about ``most`` bytes, with their texts.

    Other columns stay in Arrow, so null and large ids pass unchanged. A text
    longer than that is a run of its own; null texts become empty.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(text), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(base + most, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()
            start = stop


def components(edges: DataFrame, once: bool = False) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``: the smallest node reachable.

    Each phase hooks every node to its smallest neighbour, shortens those
    pointers to their roots by doubling, and contracts the edges to the roots;
    a phase at least halves the nodes that still have edges. A hub only meets
    map-side combined minima and joins against a side with unique keys, and
    every phase is written to shared storage. No edges give no rows. ``once`` says
    that few edges are repeated, so that they need no shuffle at first.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    edges = landed(edges if once else edges.distinct(), "edges")
    total = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        roots = landed(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")),
            "roots",
        )
        while True:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = landed(
                roots.join(up, "root").select("node", F.col("above").alias("root"), (F.col("above") < F.col("root")).alias("moved")),
                "roots",
            )
            roots = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        low = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        high = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = landed(
            edges.join(low, "a").join(high, "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .filter("a < b").distinct(),
            "edges",
        )
        if total is None:
            total = roots
        else:
            moved = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            total = landed(
                total.join(moved, "root", "left").select("node", F.coalesce("above", "root").alias("root")),
                "roots",
            )
    if total is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return total.withColumnRenamed("root", "component")


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned CRC-32 of an ASCII text, by half bytes."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    step = lambda crc, bits: f"xor({crc} >> 4, ({table}::BIGINT[])[(xor({crc}, {bits}) & 15) + 1])"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split({text}, '')]), "
        f"lambda crc, b: {step(step('crc', 'b'), '(b >> 4)')}))"
    )
