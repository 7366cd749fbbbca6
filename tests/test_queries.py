"""Every query against its SQL, on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from changelake.plans import oracle, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("customer", "events", "lineitem", "orders", "part"):
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def test_every_query_has_its_sql():
    assert set(queries.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = df.collect()
    want = duck.execute(oracle.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, got) == rows(columns, want.fetchall())


@pytest.mark.parametrize("shift", [-5_000, 2_000_000, 25_000_000])
def test_slot_history_at_any_position(spark, tmp_path, shift):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE events AS SELECT * REPLACE (event_id + {shift} AS event_id) FROM read_parquet('{SF}/events.parquet') UNION ALL SELECT * REPLACE (NULL AS event_id) FROM read_parquet('{SF}/events.parquet') WHERE event_id % 100 = 0")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    got = queries.QUERIES["slot_history"](spark, str(tmp_path)).select("slot", "verdict", "seen").collect()
    assert rows("svn", got) == rows("svn", con.execute(oracle.SQL["slot_history"]).fetchall())
