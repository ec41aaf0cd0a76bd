"""Every registered query against its DuckDB oracle (same tables, same SQL the
driver runs), at sf0.001; rows-only queries must run and give rows."""

import duckdb
import pytest

import __spark_entry__ as E
from reviewflow.plans import QUERIES as OWN
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
# the optional training-data queries have tests of their own
QUERIES = {name: fn for name, fn in E.queries().items() if name in OWN}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert rows, name
        return
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows) == digest(ocols, orows)
