"""Registered queries against their SQL, where there is some."""

from __future__ import annotations

import datetime

import duckdb
import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = __spark_entry__.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = db.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want


def test_a_price_sync_counts_events_of_one_time(spark, tmp_path):
    c = duckdb.connect()
    c.execute(f"copy (select * from '{DATA}/events.parquet' union all select event_id + 1000000, ts, user_id, event_type, value + 1, props from '{DATA}/events.parquet' where event_id % 3 = 0) to '{tmp_path}/events.parquet' (format parquet)")
    c.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    df = __spark_entry__.queries()["price_update"](spark, str(tmp_path))
    want = c.execute(f"select {', '.join(df.columns)} from ({__spark_entry__.oracle_sql()['price_update']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
