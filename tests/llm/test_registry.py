"""Every query with SQL equals it; every query has a stable schema; nothing else imports the subpackage."""

from __future__ import annotations

import os
import re

import duckdb
import pandas as pd
import pytest
from cases import sf  # noqa: F401

from touchline.llm import registry

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _rows(df):
    """Rows as comparable tuples: numbers by value, nulls alike."""
    cells = lambda v: None if pd.isna(v) else repr(float(v)) if isinstance(v, float) and not float(v).is_integer() else str(int(v)) if isinstance(v, float) else str(v)
    return sorted((tuple(map(cells, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got, want = registry.QUERIES[name](spark, sf).toPandas(), con.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_numbered_operators():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES) == list(range(1, 14))


def test_nothing_else_imports_it():
    for folder, _, names in os.walk(os.path.join(ROOT, "touchline")):
        if os.path.basename(folder) == "llm":
            continue
        for n in names:
            if n.endswith(".py") and "llm" not in folder:
                with open(os.path.join(folder, n), encoding="utf-8") as f:
                    assert "touchline.llm" not in f.read(), n
