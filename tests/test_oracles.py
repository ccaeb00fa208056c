"""Every query of the library with SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from strandloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("part", "lineitem", "orders", "events", "supplier", "nation", "region", "customer", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    rnd = lambda v: round(v, 5) if isinstance(v, float) else v
    want = sorted((tuple(map(rnd, r)) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(rnd(r[c]) for c in cols) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
