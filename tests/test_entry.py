"""Driver contract: entry() runs; every query matches its oracle SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["state", "total_rigs_count", "total_earthquake_count", "avg_earthquake_magnitude",
                          "rig_rank", "rig_position"]


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    srows = df.collect()
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    order_s = [cols.index(c) for c in sorted(cols)]
    order_d = [dcols.index(c) for c in sorted(cols)]
    a = sorted(tuple(_norm(r[i]) for i in order_s) for r in srows)
    b = sorted(tuple(_norm(r[i]) for i in order_d) for r in drows)
    assert len(a) == len(b)
    assert a == b
