"""Tier 1: every registered query against its DuckDB oracle (sf0.001), and rows-only
queries run to completion."""

import duckdb
import pytest

import __spark_entry__ as E
from flowlab.plans import QUERIES as PLANS
from tools.oracle_check import TABLES, canon

from .conftest import SF_SMALL

QUERIES = {k: v for k, v in E.queries().items() if k in PLANS}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in PLANS}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    r = con.execute(ORACLES[name])
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(cols, rows) == canon(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rounding_list_matches_schema(spark, name):
    """ROUND_COLS must list exactly the top-level double columns of each query."""
    from pyspark.sql import types as T

    from flowlab.plans.rounding import ROUND_COLS

    if name not in ORACLES:
        return
    df = PLANS[name](spark, SF_SMALL)
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    assert doubles == ROUND_COLS.get(name, [])


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rule_id", "outcome", "n", "amount"]
    assert sum(r["n"] for r in rows) > 0
