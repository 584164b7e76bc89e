"""Fingerprints of tables as multisets of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seeds of the two row hashes, which know nothing of each other.
SEEDS = (17, 71)


def row_hash(columns: list[str], seed: int) -> Column:
    """64 bits of a row; a null is told from a missing column, so moving it changes the hash."""
    quoted = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(seed), *quoted, *[c.isNull() for c in quoted])


def fingerprint(columns: list[str]) -> Column:
    """Aggregate of rows that doesn't depend on their order or layout, but on how often each occurs.

    The sums of two row hashes, as text. Sums of parts add up to the sum of the
    whole (see added). Unlike an exclusive or, a sum doesn't lose a row that is
    there twice.
    """
    order = sorted(columns)
    sums = [F.coalesce(F.sum(row_hash(order, s).cast("decimal(20,0)")), F.lit(0)).cast("string") for s in SEEDS]
    return F.concat_ws(":", *sums)


def added(parts: list[str]) -> str:
    """Fingerprint of a table from those of its parts."""
    pairs = [tuple(map(int, p.split(":"))) for p in parts]
    return ":".join(str(sum(p[k] for p in pairs)) for k in range(len(SEEDS)))
