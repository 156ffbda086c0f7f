"""Every query that SQL can say, held against DuckDB."""

import duckdb
import pytest

from chatterloom.plans import registry

AT = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as from '{AT}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, AT)
    want = duck.sql(registry.ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = sorted(tuple(map(str, r)) for r in got.select(cols).collect())
    assert rows == sorted(tuple(str(dict(zip(want.columns, r))[c]) for c in cols) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 15
