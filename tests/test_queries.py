import math

import duckdb
import pytest

from eocube.plans import queries as engine

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def normal(rows):
    def one(v):
        return None if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(map(one, r)) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(engine.SQL))
def test_query_equals_sql(spark, duck, name):
    df = engine.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    cur = duck.execute(engine.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert normal(df.select(*cols).collect()) == normal([tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()])


def test_filters_and_columns_reach_the_scan(spark):
    df = engine.QUERIES["select_time"](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual" in plan and "l_tax" not in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
