"""Every registered query vs its DuckDB oracle (row count, schema, values) at sf0.001."""

import os
import sys

import duckdb
import pytest

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, canon, spark_type  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    from queryscope.oracle import ORACLE
    from queryscope.registry import QUERIES
    missing = set(QUERIES) - set(ORACLE)
    assert not missing


@pytest.mark.parametrize("key", sorted(__import__("queryscope.oracle", fromlist=["ORACLE"]).ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[key])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    st = dict(zip(df.columns, [spark_type(f.dataType) for f in df.schema.fields]))
    ot = dict(zip(res.columns, [str(t) for t in res.types]))
    assert st == ot
    assert len(rows) == len(orows)
    assert canon(rows, df.columns, False) == canon(orows, res.columns, False)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_date", "total_search_sessions", "engaged_sessions", "engagement_rate_pct"]
