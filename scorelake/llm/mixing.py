"""Mixing of sources to target weights by thresholds on a hash.

Tokens are summed by source and hash bucket. Within a source the buckets below
the budget are taken whole; only the bucket in which the budget ends is divided
again, by the next bits of the hash, until a row is all that is left of it. A row
is taken if its hash lies below the threshold, so a larger budget takes a
superset of a smaller one, nothing is sorted, and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, checkpointed

#: Bits that one histogram resolves, and the most histograms: they cover the 62 bits of the hash and 62 of the row's place.
BITS, LEVELS = 12, 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sources (source, source_size) with target: weights repeat in the order of code points, null last.

    The targets are shares of `share` times all sizes; none exceeds `most` times
    its source, and what is cut off is shared out again by weight. With the
    sources in the order of size over weight, the first ones are cut, and what
    each step leaves to the others follows from sums over those before.
    """
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(1))
    ranked = sources.withColumn("place", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", weight)
    ranked = ranked.withColumn("limit", F.col("source_size") * float(most)).withColumn("ratio", F.col("limit") / F.col("weight"))
    before = everything.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", rest / open_weight)
    stop = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)  # the first that is not cut
    return ranked.withColumn("target", F.least("limit", F.coalesce(stop["level"] * F.col("weight"), F.col("limit")))).select("source", "source_size", "target")


def _digit(level: int) -> Column:
    word, used = ("hash", level * BITS) if level * BITS < 62 else ("place", level * BITS - 60 - 12)
    width = min(BITS, 62 - used)
    return F.shiftright(word, 62 - used - width).bitwiseAND((1 << width) - 1).cast("int")


def _keyed(docs: DataFrame, *kept: Column) -> DataFrame:
    """docs as kept, source, size, and hash and place as 62-bit numbers; place tells equal rows apart.

    The hash is made of the first 60 bits of a digest of id and text.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))
    place = F.shiftright(F.xxhash64(F.monotonically_increasing_id()), 2).bitwiseAND((1 << 62) - 1)
    return docs.select(*([F.struct(*kept).alias("kept")] if kept else []), "source", word_count(F.col("text")).alias("size"), (F.conv(F.substring(key, 1, 15), 16, 10).cast("long") * 4).alias("hash"), place.alias("place"))


def thresholds(rows: DataFrame, weights: tuple[float, ...], share: float, most: float) -> tuple[DataFrame, int, int]:
    """A row per source: s, source_size, target, whole (times that every row is taken) and the digits of its threshold.

    rows (checkpointed) has source, size, hash and place. Also returns the number of
    sources and of digits.
    """
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = sources.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = checkpointed(plan.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")).withColumnRenamed("source", "s"))
    count = plan.count()
    inside = rows.filter("size > 0").join(bounded(plan.select("s", "number"), count, 64), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    edge, marks = plan.filter("budget > 0").select("number", F.col("budget").alias("left")), plan  # sources whose boundary bucket is open
    for level in range(LEVELS):
        sums = inside.join(bounded(edge, count, 32), "number").groupBy("number", "left", _digit(level).alias("digit")).agg(F.sum("size").alias("held"), F.count("*").alias("n"))
        sums = sums.withColumn("upto", F.sum("held").over(Window.partitionBy("number").orderBy("digit"))).filter("upto + 0.5 >= left")
        cut = sums.groupBy("number").agg(F.min(F.struct("digit", "held", "n", F.expr("left - (upto - held)").alias("left"))).alias("c")).select("number", "c.*")
        last = F.lit(True) if level + 1 == LEVELS else F.col("n") == 1
        cut = checkpointed(cut.withColumn("up", F.when(last, 2 * F.col("left") >= F.col("held"))))
        marks = marks.join(bounded(cut.select("number", F.col("digit").alias(f"d{level}"), F.col("up").alias(f"up{level}")), count, 32), "number", "left")
        open_ends = cut.filter("up is null")
        if not open_ends.count():
            break
        edge = open_ends.select("number", "left")
        inside = inside.join(bounded(open_ends.select("number", F.col("digit").alias("d")), count, 32), "number").filter(_digit(level) == F.col("d")).drop("d")
    return checkpointed(marks.drop("number")), count, level + 1


def _times(digits: int) -> Column:
    """How often a row is taken: whole, and once more if its hash lies below the threshold."""
    more = F.lit(False)
    for level in range(digits - 1, -1, -1):
        d, up, at = F.col(f"d{level}"), F.col(f"up{level}"), _digit(level)
        more = F.when(d.isNull(), F.lit(False)).otherwise((at < d) | ((at == d) & F.when(up.isNull(), more).otherwise(up)))
    return F.col("whole") + more.cast("long")


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """How often each row of docs (doc_id, text, source) is taken so that the sources reach their targets.

    Returns the columns of `keep` with source, size (words), source_size, target (of
    the source) and taken (words, repeats counted). Every row is taken the whole
    number of times that its source's target holds its size; the rest is taken
    from the rows of the lowest hashes, so a source misses its target by half the
    size of one row at most. A null source is one source, a null text has size 0,
    equal rows are told apart by their place, and an empty table gives an empty
    result.
    """
    kept = [F.col(c) for c in keep if c != "source"]
    rows = checkpointed(_keyed(docs, *kept))
    marks, count, digits = thresholds(rows, weights, share, most)
    joined = rows.join(bounded(marks, count, 256), F.col("source").eqNullSafe(F.col("s")))
    return joined.select(*(["kept.*"] if kept else []), "source", "size", "source_size", "target", (F.col("size") * _times(digits)).alias("taken"))


def repeat(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """The rows of docs as often as the mix takes them, with their columns; texts without words go."""
    rows = checkpointed(_keyed(docs).select("source", "size", "hash", "place"))
    marks, count, digits = thresholds(rows, weights, share, most)
    marks = marks.select("s", "whole", *[f"{k}{i}" for i in range(digits) for k in ("d", "up")])
    keyed = _keyed(docs, F.struct(*docs.columns).alias("row"))
    joined = keyed.filter("size > 0").join(bounded(marks, count, 256), F.col("source").eqNullSafe(F.col("s")))
    times = joined.select("kept.row", _times(digits).alias("times")).filter("times > 0")
    return times.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("row.*")
