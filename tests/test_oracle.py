"""Every registered query against its DuckDB twin (the driver's check, small scale)."""

import pytest

from tests.oracle_check import digest, duck

import __spark_entry__ as E
from sparksweep.plans import registry

registry.load_all()
ORACLE = dict(registry.ORACLE)
QUERIES = {name: fn for name, fn in E.queries().items() if name in registry.QUERIES}  # the library's own


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, sf_dir, con, name):
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.sql(ORACLE[name])
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(res.columns)
    assert len(srows) == len(drows)
    sh, sl = digest(sdf.columns, srows)
    dh, dl = digest(res.columns, drows)
    assert sh == dh, (sorted(set(sl) - set(dl))[:3], sorted(set(dl) - set(sl))[:3])


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert {"trial_no", "slope", "shift", "kind", "mae", "mse"} <= set(df.columns)
