"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001 so the suite stays fast; scripts/check_oracle.py runs sf0.01."""

from __future__ import annotations

import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL, duck
from touchline.plans.oracle import oracle_sql
from touchline.plans.registry import queries

QUERIES, SQL = queries(), oracle_sql()
KEYS = sorted(QUERIES)


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else v)
        df[c] = df[c].map(lambda v: repr(float(v)) if isinstance(v, float) else v)
    df = df.astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = con.sql(SQL[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    for c in got.columns:
        assert str(got[c].dtype) == str(want[c].dtype), c
    assert _norm(got).equals(_norm(want))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:6] == ["team_name", "team_id", "player_name", "player_id",
                              "player_number", "player_positions"]


@pytest.mark.parametrize("key", ["all_player_stats", "team_fouls", "heatmap_smooth", "season_events"])
def test_heavy_queries_match_oracle_at_sf001(spark, key):
    """The driver's scale (sf0.01) for the widest plans."""
    from conftest import SF_MID

    got = QUERIES[key](spark, SF_MID).toPandas()
    want = duck(SF_MID).sql(SQL[key]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert _norm(got).equals(_norm(want))
