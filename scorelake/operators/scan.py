"""Scans along an order within keys, of which one may hold most rows.

A plain window puts all rows of a key into one task. Here a key with many rows is
cut into blocks along its order, so that blocks are scanned by themselves, and only
what a block hands on (its number of rows, its first and last value that is not
null) is scanned once more, in the order of the blocks: two levels of one prefix
scan. Keys with few rows are one block each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.documents import bounded

#: Rows of a block; a key with more is cut.
BLOCK = 1_000_000
#: Accuracy of the cuts: a block has 1 / ACCURACY of the key's rows too many at most, besides rows that are equal in the order.
ACCURACY = 10_000


def _same(keys: list[str], other: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{other}.{k}").eqNullSafe(F.col(f"rows.{k}"))
    return out


def _places_among(rows: DataFrame, cuts: str, place: str, most: int) -> DataFrame:
    """rows with _block, how many of the row's sorted cuts (at most `most`) lie below its place; 0 where either is null.

    A binary search of one column per step: the steps grow with the logarithm of
    the cuts, and no row takes a copy of them.
    """
    rows = rows.withColumn("_block", F.lit(0))
    for k in reversed(range(most.bit_length())):
        probe = F.get(F.col(cuts), F.col("_block") + F.lit((1 << k) - 1))
        rows = rows.withColumn("_block", F.col("_block") + F.when(probe < F.col(place), F.lit(1 << k)).otherwise(F.lit(0)))
    return rows


def with_blocks(rows: DataFrame, keys: list[str], order: str, block: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """rows with _block, the number of the row's block within its key; the keys that have several blocks; how many these have at most.

    order is a number or a time; null comes first, and equal values lie in one
    block. The cuts are quantiles of the order, found by a mergeable sketch for
    the large keys alone; there are no more of these than rows / block. Keys that
    need 2^k to 2^(k+1) - 1 parts are cut alike, into the most that one of them
    needs, so that all cuts together stay in proportion to rows / block.
    """
    spark = rows.sparkSession
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > block)
    needed = [(tuple(r)[:-1], -(-r["_n"] // block)) for r in large.collect()]  # rows / block at most
    if not needed:
        return rows.withColumn("_block", F.lit(0)), large, 0
    most = {parts.bit_length(): parts for parts in sorted(parts for _, parts in needed)}
    found, sizes = [(key, most[parts.bit_length()]) for key, parts in needed], sorted(most.values())
    blocks, schema = sum(parts for _, parts in found), rows.select(*keys).schema
    named = bounded(spark.createDataFrame([(*key, parts) for key, parts in found], T.StructType([*schema.fields, T.StructField("_parts", T.IntegerType())])), len(found), 256)
    names = named.drop("_parts")
    timed = dict(rows.dtypes)[order].startswith("timestamp")
    place = (F.unix_micros(F.col(order).cast("timestamp")) if timed else F.col(order)).cast("double")
    held = rows.withColumn("_place", place).alias("rows").join(named.alias("names"), _same(keys, "names")).select("rows.*", "_parts")
    sketches = [F.percentile_approx(F.when(F.col("_parts") == n, F.col("_place")), [k / n for k in range(1, n)], ACCURACY) for n in sizes]
    cuts = held.groupBy(*keys).agg(F.coalesce(*sketches).alias("_cuts")).collect()  # blocks in all
    table = bounded(spark.createDataFrame([tuple(r) for r in cuts], T.StructType([*schema.fields, T.StructField("_cuts", T.ArrayType(T.DoubleType()))])), 1, 256 * len(cuts) + 8 * blocks)
    joined = rows.withColumn("_place", place).alias("rows").join(table.alias("table"), _same(keys, "table"), "left").select("rows.*", "_cuts")
    return _places_among(joined, "_cuts", "_place", sizes[-1] - 1).drop("_place", "_cuts"), names, blocks


def scan(rows: DataFrame, keys: list[str], order: list[str], *, number: str | None = None, last: dict[str, str] | None = None, following: dict[str, str] | None = None, block: int = BLOCK) -> DataFrame:
    """rows with new columns, in the order within each key; the first column of order is a number or a time, and nulls of it come first.

    number: name for the row's number from 1. last: for each new name a column whose
    value of this row or the last one before that has any is wanted. following: the
    same for the next value behind this row. Keys may be null; an empty table gives
    an empty result.
    """
    last, following = last or {}, following or {}
    blocked, several, blocks = with_blocks(rows, keys, order[0], block)
    by = Window.partitionBy(*keys, "_block").orderBy(*[F.asc_nulls_first(c) for c in order])
    back = Window.partitionBy(*keys, "_block").orderBy(*[F.desc_nulls_last(c) for c in order])
    behind, ahead = by.rowsBetween(Window.unboundedPreceding, Window.currentRow), back.rowsBetween(Window.unboundedPreceding, -1)  # frames that end with the partition take quadratic time
    local = {f"_at_{k}": F.last(c, ignorenulls=True).over(behind) for k, c in last.items()}
    local |= {f"_at_{k}": F.last(c, ignorenulls=True).over(ahead) for k, c in following.items()}
    local["_number"] = F.row_number().over(by).cast("long")
    within = blocked.withColumns(local)
    if not blocks:
        own = {k: F.col(f"_at_{k}") for k in (*last, *following)} | ({number: F.col("_number")} if number else {})
        return within.select(*[c for c in rows.columns if c not in own], *[v.alias(k) for k, v in own.items()])
    place = F.struct(*order)
    handed = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_end_{k}") for k, c in last.items()]
    handed += [F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_end_{k}") for k, c in following.items()]
    large = blocked.alias("rows").join(several.alias("several"), _same(keys, "several"), "left_semi")
    ends = large.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"), *handed)
    along = Window.partitionBy(*keys)  # a row per block
    before, after = (along.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("_block"), F.desc("_block")))
    carried = {f"_carry_{k}": F.last(f"_end_{k}", ignorenulls=True).over(before) for k in last}
    carried |= {f"_carry_{k}": F.last(f"_end_{k}", ignorenulls=True).over(after) for k in following}
    carried["_before"] = F.sum("_rows").over(before)
    states = ends.withColumns(carried).select(*keys, "_block", *carried)
    joined = within.alias("rows").join(bounded(states, blocks, 256).alias("states"), _same([*keys, "_block"], "states"), "left")
    out = {k: F.coalesce(F.col(f"rows._at_{k}"), F.col(f"states._carry_{k}")) for k in (*last, *following)}
    if number:
        out[number] = F.col("rows._number") + F.coalesce(F.col("states._before"), F.lit(0))
    return joined.select(*[F.col(f"rows.{c}") for c in rows.columns if c not in out], *[v.alias(k) for k, v in out.items()])
