"""Each query of the library against its SQL in DuckDB, on the smallest tables."""

import decimal
import pathlib

import duckdb
import pytest

from quillsift import plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no driver tables")


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return tuple(map(norm, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in pathlib.Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(plans.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert found == sorted((tuple(norm(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("first", [(1 << 20) - 500, (1 << 23) - 500, 10**12])
def test_shown_values_of_large_keys(spark, duck, tmp_path, first):
    duck.execute(f"copy (select o_orderkey + {first} as o_orderkey, * exclude o_orderkey from '{SF}/orders.parquet') to '{tmp_path}/orders.parquet' (format parquet)")
    df = plans.QUERIES["shown_values"](spark, str(tmp_path))
    own = duckdb.connect()
    own.execute(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    result = own.execute(plans.SQL["shown_values"])
    names = [d[0] for d in result.description]
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(result.fetchall())
