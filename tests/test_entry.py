"""The contract: every query with an oracle gives the oracle's rows on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from tideline.plans import market_oracles, market_queries
from tideline.plans.catalog import plain

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHEAP = sorted(market_oracles())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def texts(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    show = lambda x: "null" if x is None or (not isinstance(x, str) and pd.isna(x)) else f"{x:.9g}" if isinstance(x, float) else f"{float(x):.9g}" if isinstance(x, (int, bool)) or hasattr(x, "item") else str(x)
    return sorted(tuple(map(show, r)) for r in df.itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", CHEAP)
def test_query_equals_oracle(spark, duck, name):
    ours, theirs = market_queries()[name](spark, DATA).toPandas(), duck.sql(market_oracles()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert texts(ours) == texts(theirs)


def test_rounded_like_the_sql(spark):
    """At halves of the last place, where a double reads as more than it is."""
    xs = [k / 640 for k in range(-500, 500)] + [1.0418625, 1.0996375, 0.8193125, 1e300, -1e306, 4e15 + 0.5, math.nan, math.inf, -math.inf, 0.0, None]
    xs += [math.nextafter(x, s * math.inf) for x in xs[:500] for s in (-1, 1)]
    got = plain(spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double")).orderBy("i").collect()
    con = duckdb.connect()
    con.sql("create table t (i bigint, x double)")
    con.executemany("insert into t values (?, ?)", [(i, x) for i, x in enumerate(xs)])
    want = con.sql("select round(x, 6) + 0.0 from t order by i").fetchall()
    assert [str(r.x) for r in got] == [str(x) for x, in want]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
