"""The queries that SQL can express, held against it on the smallest tables."""

import collections
import os

import pytest

from scorelake.llm import queries

FOLDER = "/root/testdata/sf0.001"


def told(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    df = queries.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = con.execute(queries.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(c) for c in columns]
    assert len(order) == len(want.description)
    rows = collections.Counter(tuple(told(r[i]) for i in order) for r in want.fetchall())
    assert collections.Counter(tuple(map(told, r)) for r in df.select(*columns).collect()) == rows
