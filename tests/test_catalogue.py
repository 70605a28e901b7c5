"""Every query of the catalogue against its SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from millrace.plans.catalogue import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(tiny):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def rows(names, order, data):
    at = [names.index(n) for n in order]
    return sorted((tuple(plain(r[k]) for k in at) for r in data), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, tiny, name):
    got = QUERIES[name](spark, tiny)
    found = got.collect()
    assert name in SQL
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, sorted(names), found) == rows(names, sorted(names), want.fetchall())
