"""Every registered query of the library against its SQL on the smallest tables."""

import decimal

import duckdb
import pytest
from lodestack.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    return bytes(v).hex() if isinstance(v, (bytes, bytearray)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    result = db.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(plain(v) for v in r) for r in result.fetchall())
    assert sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()) == want


def test_flagship(spark):
    assert registry.flagship(spark, SF).count() > 0


def test_layers_are_shuffled_once(spark):
    plan = registry.QUERIES["x11_u02_merge_manifest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "sha2" not in plan[plan.index("Exchange") :]  # digests are made above it
