"""Every registered query against its SQL on the smallest tables."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from plumbline.plans import registry

SMALL = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SMALL.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def comparable(rows):
    def value(v):
        return float(v) if isinstance(v, Decimal) else v

    return sorted((tuple(map(value, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, str(SMALL))
    want = duck.execute(registry.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.select(*columns).collect()) == comparable(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, str(SMALL)).count() > 0
