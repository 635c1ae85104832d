"""Every registered query against its SQL, on the smallest given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from registered.oracle import ORACLE as REGISTERED
from registered.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows, names):
    order = [names.index(n) for n in sorted(names)]
    clean = (tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows)
    return sorted(clean, key=repr)


def test_every_query_has_sql():
    """Every query of the registered modules; optional folders may hold operators that SQL can't express."""
    assert set(QUERIES) == set(REGISTERED) and set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    mine = _sorted(df.collect(), df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert mine == _sorted(result.fetchall(), names)


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "volatility_rank" in df.columns
