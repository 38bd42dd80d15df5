"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

from oracle import connect, difference
from quayside.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = connect(FOLDER)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), ORACLES[name], con) is None


def test_windowed_counts_match_closed_windows(spark):
    """Streamed windows equal the batch sums of the same hours; only the last may be open."""
    import duckdb

    got = {(r[0].replace(tzinfo=None), r[1]): (r[2], r[3]) for r in QUERIES["st_windowed_counts"](spark, FOLDER).collect()}
    want = duckdb.sql(f"""
        SELECT date_trunc('hour', ts), event_type, COUNT(*), CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
        FROM '{FOLDER}/events.parquet' GROUP BY ALL""").fetchall()
    want = {(r[0], r[1]): (r[2], r[3]) for r in want}
    assert got and all(want[k] == v for k, v in got.items())
    last = max(k[0] for k in got)
    assert {k for k in want if k[0] <= last} == set(got)
    assert len(want) - len(got) <= 10


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
