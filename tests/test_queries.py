"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import decimal
import math

import duckdb
import pytest

import tracesieve.plans.all  # noqa: F401
from tracesieve.plans.registry import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return "nan" if math.isnan(v) else repr(round(float(v), 7) + 0.0)
    if hasattr(v, "asDict"):
        v = list(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    rows = sorted("|".join(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        return
    found = duck.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted("|".join(plain(r[i]) for i in at) for r in found.fetchall())
