"""Driver contract: entry smoke, and every registered query against its DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries()) >= set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name, capsys):
    sdf = E.queries()[name](spark, SF)
    sdf.explain()
    plan = capsys.readouterr().out
    # no pairing of all rows: every join is keyed
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cols = sdf.columns
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    srows = Counter(tuple(norm(r[c]) for c in sorted(cols)) for r in sdf.collect())
    drows = Counter(tuple(norm(v) for _, v in sorted(zip(dcols, r))) for r in cur.fetchall())
    assert srows == drows
