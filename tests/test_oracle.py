"""Every batch query against DuckDB on whole tables. The streams have tests of their own."""

import pytest

from oracle import compare, connect
from tidemill.plans.oracle import ORACLE
from tidemill.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.01"
BATCH = [n for n in QUERIES if n in ORACLE and not n.startswith("stream_")]


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", BATCH)
def test_matches_duckdb(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


def test_entry_has_rows(spark):
    import __spark_entry__

    hours = __spark_entry__.entry(spark)
    assert hours.columns == ["log_hour", "ct"]
    assert hours.count() > 0
