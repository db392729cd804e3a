"""Every registered query against its DuckDB oracle, on sf0.001.

The driver runs the same comparison on sf0.01; ``tools/check_oracle.py`` does it by hand.
"""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from cinesift.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import compare


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    expected = res.fetchall()
    err = compare(got, df.columns, expected, [d[0] for d in res.description])
    assert err is None, err
    assert got, "empty result"
