"""Every query with an oracle equals its DuckDB SQL on the small tables."""

import duckdb
import pytest

from lendscope.plans.registry import ORACLE, QUERIES
from lendscope.sources.tables import TABLES
from tools.check_oracle import norm

NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, small, con, name):
    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert cols == sorted(ocols)
    exp = sorted(tuple(norm(r[ocols.index(c)]) for c in cols) for r in res.fetchall())
    assert got == exp


def test_every_query_has_a_builder():
    assert set(ORACLE) <= set(QUERIES)
