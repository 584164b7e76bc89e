import random
import time

import pytest
from pyspark.sql import functions as F

from scorelake.operators.scan import scan, with_blocks

SCHEMA = "k long, at long, id long, v string, w double"


def random_rows(n=600, hot=400):
    rng = random.Random(6)
    rows = [(7 if i < hot else rng.choice([1, 2, None]), rng.choice([None, rng.randrange(300), rng.randrange(300)]), i, rng.choice([None, None, f"v{i}"]), float(i) if rng.random() < 0.1 else None) for i in range(n)]
    return [(k, at, i, None if k == 7 and at is not None and 50 < at < 200 else v, w) for k, at, i, v, w in rows]  # blocks without any value


def plain(rows):
    out, by = set(), {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for n, r in enumerate(rs):
            last = next((x[3] for x in rs[n::-1] if x[3] is not None), None)
            following = next((x[4] for x in rs[n + 1 :] if x[4] is not None), None)
            out.add((k, r[2], n + 1, last, following))
    return out


@pytest.mark.parametrize("block", [40, 150, 10**6])
def test_scan_equals_a_plain_one(spark, block):
    rows = random_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = scan(df, ["k"], ["at", "id"], number="n", last={"known": "v"}, following={"next": "w"}, block=block)
    assert got.columns == ["k", "at", "id", "v", "w", "known", "next", "n"]
    assert {(r.k, r.id, r.n, r.known, r.next) for r in got.collect()} == plain(rows)
    assert scan(df.filter("false"), ["k"], ["at"], number="n").count() == 0


def test_no_task_holds_a_hot_key(spark):
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.timestamp_micros(F.col("id") * 1000).alias("at"), "id", F.when(F.col("id") % 100 == 0, F.col("id")).alias("v"))
    blocked, several, blocks = with_blocks(df, ["k"], "at", 1000)
    assert [r.k for r in several.collect()] == [-1] and blocks == 27
    sizes = [r["count"] for r in blocked.filter("k = -1").groupBy("_block").count().collect()]
    assert len(sizes) >= 26 and max(sizes) <= 1100 and sum(sizes) == n - (n + 2) // 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        got = scan(df, ["k"], ["at"], number="n", last={"known": "v"}, block=1000)
        tasks = [r["rows"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.max("n"), F.max("known")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(tasks) == n and max(tasks) < n / 6
    hot = got.filter("k = -1")
    assert hot.agg(F.max("n"), F.count_distinct("n")).first() == (sum(sizes), sum(sizes))
    assert hot.filter("id > 200 AND (known IS NULL OR id - known > 300)").count() == 0


def test_time_follows_the_rows_and_not_the_blocks(spark):
    """Rows times blocks would be 4e9 comparisons of a cut with a row's place."""
    n = 400_000
    df = spark.range(n).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 100 < 2, F.col("id")).alias("v"))
    began = time.perf_counter()
    scan(df.filter("id < 4000"), ["k"], ["at"], number="n", last={"known": "v"}, following={"next": "v"}, block=20).agg(F.count("*")).first()
    few = time.perf_counter() - began
    blocked, several, blocks = with_blocks(df, ["k"], "at", 20)
    assert blocks == n // 20 and several.count() == 2
    wrong = (F.col("n") != F.floor(F.col("at") / 2) + 1) | (F.col("known") != F.col("at") - F.col("at") % 100 + F.col("k")) | (F.col("next") != F.col("at") - F.col("at") % 100 + 100 + F.col("k"))
    began = time.perf_counter()
    got = scan(df, ["k"], ["at"], number="n", last={"known": "v"}, following={"next": "v"}, block=20).agg(F.count("*"), F.count_if(wrong), F.count_if(F.col("next").isNull())).first()
    assert tuple(got) == (n, 0, 100)
    assert time.perf_counter() - began < 20 + 10 * few


def test_keys_of_many_sizes_are_cut_in_proportion(spark):
    df = spark.range(60_000).select(F.floor(F.log2(F.col("id") + 1)).alias("k"), "id")
    blocked, several, blocks = with_blocks(df, ["k"], "id", 100)
    sizes = blocked.groupBy("k", "_block").count().collect()
    assert blocks <= 2 * 600 + several.count() and max(r["count"] for r in sizes) <= 110
    assert several.count() == 9 and len(sizes) == blocks + 7
