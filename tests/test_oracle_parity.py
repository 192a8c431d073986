"""Every registered query equals its SQL oracle (DuckDB) on the smallest
driver tables: same columns, same number of rows, same multiset of values."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import rows_of
from shelfspark.plans.fixtures import TABLES
from small_tables import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)
