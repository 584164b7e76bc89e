"""Pages of a total order that lie deep within it, without sorting what comes before.

The place of an offset is found by order statistics: a histogram of the sort key
tells the bucket with the offset's row, and is refined inside that bucket alone
until few rows are left or all have one key. Only the rows between the two ends of
the page are sorted. Whoever goes on from page to page can name the last row
instead of an offset.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of one histogram, and rows of a bucket that needs no further one.
BUCKETS, FEW = 1024, 10_000
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def in_order(rows: DataFrame, order_by: str, ties: Sequence[str], descending: bool = False) -> DataFrame:
    """rows by a key with nulls last either way, then by ties in ascending order."""
    first = F.col(order_by).desc_nulls_last() if descending else F.col(order_by).asc_nulls_last()
    return rows.orderBy(first, *[F.col(c).asc_nulls_last() for c in ties if c != order_by])


def _bucket_of(rows: DataFrame, key: str, descending: bool, rank: int, low: Any, high: Any, before: int) -> tuple[Any, Any, int]:
    """Least and greatest key of a bucket that holds the row of a rank, and the number of rows before the bucket.

    before: rows before those from low to high.
    """
    while True:
        inside = rows.filter(F.col(key).between(low, high))
        width = (float(high) - float(low)) / BUCKETS
        number = F.least(F.floor((F.col(key).cast("double") - float(low)) / width), F.lit(BUCKETS - 1)) if width > 0 else F.lit(0)
        found = inside.groupBy(number.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()  # BUCKETS rows at most
        for r in sorted(found, key=lambda r: r["b"], reverse=descending):
            if before + r["n"] > rank:
                break
            before += r["n"]
        narrowed = (r["low"], r["high"]) != (low, high)
        low, high = r["low"], r["high"]
        if r["n"] <= FEW or low == high or not narrowed:
            return low, high, before


def page(rows: DataFrame, order_by: str, ties: Sequence[str], *, descending: bool = False, offset: int = 0, limit: int) -> DataFrame:
    """limit rows from an offset of rows in their order (see in_order), in that order.

    For a key that is a number each step reads the key alone, and the last one
    sorts the rows of a few buckets; other keys, and keys with NaN, are sorted as a
    whole. Ties of one key lie in one bucket. An offset behind the last row gives
    no row.
    """
    kind = dict(rows.dtypes)[order_by]
    whole = in_order(rows, order_by, ties, descending)
    if kind not in NUMBERS or limit <= 0:
        return whole.offset(offset).limit(max(0, limit))
    nan = F.count_if(F.isnan(order_by)) if kind in ("float", "double") else F.lit(0)
    valued, low, high, odd = rows.agg(F.count(order_by), F.min(order_by), F.max(order_by), nan).first()
    if odd:
        return whole.offset(offset).limit(limit)
    key, end = F.col(order_by), offset + limit
    if offset >= valued:
        return in_order(rows.filter(key.isNull()), order_by, ties).offset(offset - valued).limit(limit)
    first_low, first_high, before = _bucket_of(rows, order_by, descending, offset, low, high, 0)
    last_low, last_high, _ = _bucket_of(rows, order_by, descending, min(end, valued) - 1, low, high, 0)
    between = key.between(last_low, first_high) if descending else key.between(first_low, last_high)
    inside = rows.filter(between | key.isNull()) if end > valued else rows.filter(between)
    return in_order(inside, order_by, ties, descending).offset(offset - before).limit(limit)


def beyond(order_by: str, ties: Sequence[str], last: dict[str, Any], descending: bool = False) -> Column:
    """Condition of the rows that come after a row (a value for the key and each of the ties) in the order of in_order."""
    parts, equal = [], []
    for c in (order_by, *[t for t in ties if t != order_by]):
        value, column = last[c], F.col(c)
        down = descending and c == order_by
        after = F.lit(False) if value is None else column.isNull() | (column < F.lit(value) if down else column > F.lit(value))
        parts.append(reduce(lambda a, b: a & b, equal, after))
        equal.append(column.eqNullSafe(F.lit(value)))
    return F.coalesce(reduce(lambda a, b: a | b, parts), F.lit(False))
