from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from touchline.session import checkpoint_dir, local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="touchline-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def events_small(spark):
    from touchline.sources.derived import load_match_events

    return load_match_events(spark, SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="touchline-test-")


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    return con
