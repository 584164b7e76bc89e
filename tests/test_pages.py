import random

import pytest
from pyspark.sql import functions as F

from scorelake.operators import pages

SCHEMA = "k double, n int, id long, t string"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, float(rng.randrange(40)), rng.random() * 1e6, -1e12]), rng.choice([None, 7, 7, 7, rng.randrange(1000)]), i, rng.choice("abc")) for i in range(3000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.mark.parametrize("key", ["k", "n", "id", "t"])
@pytest.mark.parametrize("down", [False, True])
def test_pages_equal_those_of_the_whole_order(table, key, down, monkeypatch):
    monkeypatch.setattr(pages, "FEW", 30)
    monkeypatch.setattr(pages, "BUCKETS", 16)
    whole = [r.id for r in pages.in_order(table, key, ["t", "id"], down).collect()]
    for offset, limit in ((0, 5), (1500, 40), (2990, 40), (700, 1), (2400, 300), (5000, 3)):
        got = pages.page(table, key, ["t", "id"], descending=down, offset=offset, limit=limit)
        assert [r.id for r in got.collect()] == whole[offset : offset + limit], (offset, limit)


def test_only_rows_near_the_page_are_sorted(spark, monkeypatch):
    rows = spark.range(100_000).select(F.xxhash64("id").cast("double").alias("k"), "id")
    seen, order = [], pages.in_order
    monkeypatch.setattr(pages, "in_order", lambda df, *a: (seen.append(df), order(df, *a))[1])
    got = pages.page(rows, "k", ["id"], offset=50_000, limit=20).collect()
    assert len(got) == 20 and seen[-1].count() < 2000
    assert [r.id for r in got] == [r.id for r in order(rows, "k", ["id"]).offset(50_000).limit(20).collect()]


@pytest.mark.parametrize("key", ["k", "n", "t"])
@pytest.mark.parametrize("down", [False, True])
def test_rows_behind_the_last_one(table, key, down):
    whole = pages.in_order(table, key, ["t", "id"], down).collect()
    for at in (0, 900, 2200, 2998, 2999):
        last = whole[at].asDict()
        behind = table.filter(pages.beyond(key, ["t", "id"], last, down))
        assert behind.count() == 2999 - at
        assert [r.id for r in pages.in_order(behind, key, ["t", "id"], down).limit(3).collect()] == [r.id for r in whole[at + 1 : at + 4]]


def test_nothing_and_odd_numbers(spark, table):
    assert pages.page(table.filter("false"), "k", ["id"], offset=3, limit=2).count() == 0
    odd = spark.createDataFrame([(float("nan"), 1), (1.0, 2), (None, 3)], "k double, id long")
    assert [r.id for r in pages.page(odd, "k", ["id"], offset=0, limit=3).collect()] == [2, 1, 3]
