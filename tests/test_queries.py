"""Every registered query of the library against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from starloom.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def canonical(df):
    df = df[sorted(df.columns)]
    fix = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v) if hasattr(v, "__float__") and not isinstance(v, str) else str(v)
    return list(df.columns), sorted((tuple(fix(v) for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, db, name):
    assert canonical(queries.QUERIES[name](spark, SF).toPandas()) == canonical(db.sql(queries.SQL[name]).df())


def test_flagship(spark):
    assert queries.flagship(spark, SF).count() == 10
