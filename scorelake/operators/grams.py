"""Substring search by an index of trigrams.

The index has a row for each trigram of a text and each key (such as a contest)
under which it occurs. A search for a pattern looks up the trigrams of its literal
parts, keeps the keys that have all of them, and applies the exact condition to the
rows of these keys alone. Patterns without three literal characters in a row are
searched without the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grams(text: Column) -> Column:
    """Different trigrams of a text in lower case, as numbers; none of null and shorter texts."""
    low = F.lower(text)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(low) - 2)), lambda i: F.xxhash64(F.substring(low, i, F.lit(3))))
    return F.array_distinct(F.when(F.length(low) >= 3, each).otherwise(F.array().cast("array<bigint>")))


def index_of(rows: DataFrame, columns: list[str], key: str) -> DataFrame:
    """The index of some text columns: gram, key. Different texts of a key are taken apart once."""
    texts = rows.select(key, F.explode(F.array(*columns)).alias("text")).filter("text is not null").distinct()
    return texts.select(F.explode(grams(F.col("text"))).alias("gram"), key).distinct()


def literals(pattern: str) -> list[str]:
    """Parts of a LIKE pattern between its wildcards; a backslash makes the next character an ordinary one."""
    parts, at = [""], 0
    while at < len(pattern):
        c = pattern[at]
        if c in "%_":
            parts.append("")
        else:
            at += c == "\\"
            parts[-1] += pattern[at : at + 1]
        at += 1
    return [p for p in parts if len(p) >= 3]


def wanted(rows: DataFrame, pattern: str) -> list[int]:
    """Trigrams that a text must have to fit %pattern%; none where the index can't help."""
    parts = literals(pattern)
    if not parts:
        return []
    (found,) = rows.sparkSession.range(1).select(F.array_distinct(F.flatten(F.array(*[grams(F.lit(p)) for p in parts])))).first()
    return sorted(found)


def keys_with(index: DataFrame, key: str, found: list[int]) -> DataFrame:
    """Keys that have all of some trigrams (in any of their texts)."""
    hit = index.filter(F.col("gram").isin(found))
    return hit.groupBy(key).agg(F.count_distinct("gram").alias("_n")).filter(F.col("_n") == len(found)).select(key)


def search(rows: DataFrame, index: DataFrame, columns: list[str], key: str, pattern: str) -> DataFrame:
    """Rows of which one of the columns fits ILIKE %pattern%; those of keys without all trigrams are not looked at.

    A null key is a key like others. index is index_of the same rows, stored by
    gram so that a look-up reads little of it.
    """
    fits = F.coalesce(F.greatest(*[F.coalesce(F.col(c).ilike(f"%{pattern}%"), F.lit(False)) for c in (columns if len(columns) > 1 else columns * 2)]), F.lit(False))
    found = wanted(rows, pattern)
    if found:
        near = keys_with(index, key, found).withColumnRenamed(key, "_near")
        rows = rows.join(near, F.col(key).eqNullSafe(F.col("_near")), "left_semi")
    return rows.filter(fits)
