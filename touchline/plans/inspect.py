"""Physical-plan inspection: what a query scans, shuffles, joins and pushes down.

Used by the plan tests and by ``scripts/plan_report.py``; reads Spark's own
executed plan, nothing more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame, full_metadata: bool = True) -> str:
    """The executed physical plan as text (AQE's initial plan if adaptive)."""
    spark = df.sparkSession
    key = "spark.sql.maxMetadataStringLength"
    old = spark.conf.get(key, None)
    if full_metadata:
        spark.conf.set(key, "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        if full_metadata:
            if old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)


@dataclass
class PlanSummary:
    scans: int = 0
    shuffles: int = 0
    broadcasts: int = 0
    joins: list[str] = field(default_factory=list)
    pushed_filters: list[str] = field(default_factory=list)
    partition_filters: list[str] = field(default_factory=list)
    read_columns: list[str] = field(default_factory=list)
    cross_products: int = 0
    python_udfs: int = 0


def summarize(df: DataFrame) -> PlanSummary:
    plan = executed_plan(df)
    s = PlanSummary()
    for line in plan.splitlines():
        if "FileScan" in line or "Scan ExistingRDD" in line:
            s.scans += 1
            m = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
            if m and m.group(1):
                s.pushed_filters.append(m.group(1))
            m = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)
            if m and m.group(1):
                s.partition_filters.append(m.group(1))
            m = re.search(r"ReadSchema: struct<(.*)>", line)
            if m:
                s.read_columns.append(m.group(1))
        if re.search(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", line):
            s.shuffles += 1
        if "BroadcastExchange" in line:
            s.broadcasts += 1
        m = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)(?: \[.*?\], \[.*?\],)? (\w+)", line)
        if m:
            s.joins.append(f"{m.group(1)}:{m.group(2)}")
        if "CartesianProduct" in line or "NestedLoopJoin" in line:
            s.cross_products += 1
        if "BatchEvalPython" in line or "ArrowEvalPython" in line:
            s.python_udfs += 1
    return s
