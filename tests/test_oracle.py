"""Every registered query against its DuckDB statement on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import digest, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = digest([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_every_query_runs_and_entry_smoke(spark):
    no_oracle = set(entry.queries()) - set(entry.oracle_sql())
    for name in no_oracle:
        assert entry.queries()[name](spark, SF).count() >= 0
    e = entry.entry(spark)
    assert e.count() > 0 and "example_id" in e.columns
