import duckdb
import pytest

import __spark_entry__ as entry
from pagelake import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registry.ALL))
def test_query_equals_sql(spark, duck, name):
    f, sql = registry.ALL[name]
    got = f(spark, D).toPandas()
    if sql is None:
        assert len(got)
        return
    want = duck.execute(sql).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(got) == len(want)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (want, got))
    for c in cols:
        assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c
