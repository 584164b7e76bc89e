"""K-d tree sharding of a corpus by weighted medians.

The tree is built level by level. On each level every open node takes its widest
metadata dimension, relative to the width of the whole table, and is split where
the bytes below reach its share. The split is found by histograms: sums of bytes
by node and the next bits of the key, then only inside the bucket that holds the
median, until that bucket is small. Nothing is sorted; the driver holds the tree
alone, one entry for each leaf.

Rows with equal texts are a group. Its coordinates are those of the group (the
size of its text, the least language and source of its copies), so that its rows
lie side by side in every node, and a split goes beside it, unless the group alone
has more bytes than a shard's share: then it is cut where the bytes demand it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, checkpointed, utf8_size

#: Bits that one histogram resolves.
BITS = 12
#: A median is exact enough when its bucket holds less than this share of a leaf.
TOLERANCE = 0.002
#: Rows of a bucket of the numbering within a shard.
SLOTS = 100_000


def digits(value: Column, bits: int) -> list[Column]:
    """A number of so many bits as digits of BITS bits, the most significant first."""
    return [F.shiftrightunsigned(value, k).bitwiseAND((1 << BITS) - 1).cast("int") for k in range(BITS * (-(-bits // BITS) - 1), -1, -BITS)]


#: Columns of the dimensions, each a number of two digits.
DIMENSIONS = ("size_at", "lang_at", "source_at")


def group_digits() -> list[Column]:
    """What tells groups of equal coordinates apart."""
    return [*digits(F.col("text_crc32"), 32), *digits(F.col("hash"), 64)]


def row_digits() -> list[Column]:
    """What tells rows of one group apart."""
    return [*digits(F.col("id"), 2 * BITS), *digits(F.col("row"), 64)]


def ranked(values: DataFrame) -> tuple[DataFrame, int]:
    """Different values (one column: value) with rank, their place in ascending order, and how many there are.

    Ranges of values are numbered by themselves and moved on by the numbers of the
    ranges before, so that no task holds all values.
    """
    ranges = checkpointed(values.distinct().repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    before, starts = 0, []
    for part, n in sorted(map(tuple, ranges.groupBy("part").agg(F.count("*")).collect())):  # a row per range
        starts.append((part, before))
        before += n
    first = ranges.sparkSession.createDataFrame(starts, "part int, first long")
    numbered = ranges.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("value")))
    return numbered.join(bounded(first, len(starts), 16), "part").select("value", (F.col("first") + F.col("k") - 1).alias("rank")), before


def assign(rows: DataFrame, leaves: int) -> DataFrame:
    """rows (checkpointed; with size, DIMENSIONS and what tells groups and rows apart) with shard 0 .. leaves - 1."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = total / max(1, leaves)
    slack = max(1, int(share * TOLERANCE))
    ends = [f(k).alias(f"{n}_{k}") for k in DIMENSIONS for f, n in ((F.min, "lo"), (F.max, "hi"))]
    width = lambda r, k: (r[f"hi_{k}"] or 0) - (r[f"lo_{k}"] or 0)
    whole = rows.agg(*ends).first()
    node, open_nodes, number = F.lit(0), {0: (0, leaves)}, 1  # node: first leaf and number of leaves
    while todo := {k: v for k, v in open_nodes.items() if v[1] > 1}:
        rows = checkpointed(rows.withColumn("node", node)) if number > 1 else rows.withColumn("node", node)
        plan = {}
        for r in rows.filter(F.col("node").isin(list(todo))).groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect():
            widest, n = max(DIMENSIONS, key=lambda k: width(r, k) / max(1, width(whole, k))), todo[r["node"]][1]
            key = [*digits(F.col(widest), 2 * BITS), *group_digits()]
            plan[r["node"]] = {"key": [*key, *row_digits()], "group": len(key), "goal": r["bytes"] * (n // 2) / n, "below": 0, "prefix": [], "open": True}
        while any(p["open"] for p in plan.values()):
            parts = []
            for k, p in plan.items():
                if p["open"]:
                    same = reduce(lambda a, b: a & b, [F.col("node") == k, *[c == v for c, v in zip(p["key"], p["prefix"], strict=False)]])
                    parts.append(F.when(same, F.struct(F.lit(k).alias("node"), p["key"][len(p["prefix"])].alias("digit"))))
            sums: dict[int, list] = {}
            for r in rows.select(F.coalesce(*parts).alias("k"), "size").filter("k is not null").groupBy("k").agg(F.sum("size").alias("bytes")).select("k.node", "k.digit", "bytes").collect():
                sums.setdefault(r["node"], []).append((r["digit"], r["bytes"]))
            for k, p in plan.items():
                if p["open"]:
                    for digit, held in sorted(sums[k]):
                        if p["below"] + held > p["goal"]:
                            break
                        p["below"] += held
                    p["prefix"].append(digit)
                    if held <= slack or len(p["prefix"]) == len(p["key"]) or (len(p["prefix"]) == p["group"] and held <= share):
                        p["up"] = 2 * (p["goal"] - p["below"]) >= held  # the bucket goes where it brings the sum nearer
                        p["open"] = False
        split = []
        for k, (first, n) in todo.items():
            del open_nodes[k]
            open_nodes |= {number: (first, n // 2), number + 1: (first + n // 2, n - n // 2)} if k in plan else {k: (first, 1)}  # without rows its leaves stay empty
            if k in plan:
                split.append(F.when(F.col("node") == k, F.when(_below(plan[k]["key"], plan[k]["prefix"], plan[k]["up"]), number).otherwise(number + 1)))
                number += 2
        node = F.coalesce(*split, F.col("node"))
    leaf = F.element_at(F.create_map(*[F.lit(x) for k, (first, _) in open_nodes.items() for x in (k, first)]), F.col("at"))
    return rows.withColumn("at", node).withColumn("shard", leaf.cast("int")).withColumn("cut", F.col("group_bytes") > share).drop("at", "node")


def _below(key: list[Column], prefix: list[int], up: bool) -> Column:
    """Whether a row's digits come before the prefix, or at it if up."""
    out = F.lit(up)
    for c, v in reversed(list(zip(key, prefix, strict=False))):
        out = (c < v) | ((c == v) & out)
    return out


def number_slots(rows: DataFrame) -> DataFrame:
    """rows (kept, shard, text_crc32, hash, row) with a gapless slot in each shard, numbered in buckets so that no shard meets in one task."""
    buckets = max(1, -(-rows.count() // SLOTS)) * 4
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("text_crc32", "row"), F.lit(buckets)))
    sizes = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = checkpointed(sizes.selectExpr("shard", "bucket", "sum(n) over (partition by shard order by bucket) - n as first_slot"))
    local = rows.selectExpr("*", "row_number() over (partition by shard, bucket order by text_crc32, hash, row) as k")
    return local.join(bounded(starts, starts.count(), 32), ["shard", "bucket"]).withColumn("slot", F.col("first_slot") + F.col("k") - 1).drop("bucket", "k", "first_slot")


def coordinates(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """A light row for each row of docs, with the coordinates and bytes of its group of equal texts; checkpointed."""
    told = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) if c in docs.columns else F.lit("")  # noqa: E731  a null is a value of its own
    text = F.coalesce(F.col("text"), F.lit(""))
    size = utf8_size(F.col("text")) + 1
    light = checkpointed(docs.select(
        F.struct(*keep).alias("kept"), F.xxhash64(F.col("doc_id").cast("string")).alias("id"), size.alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("hash"), told("lang").alias("lang_value"), told("source").alias("source_value"), F.monotonically_increasing_id().alias("row"),
    ))
    groups = checkpointed(light.groupBy("text_crc32", "hash").agg(F.sum("size").alias("group_bytes"), F.min("lang_value").alias("lang_value"), F.min("source_value").alias("source_value")))  # so that both sides of the last join are dealt anew and a hot group is split
    for name in ("lang", "source"):
        ranks, n = ranked(groups.select(F.col(f"{name}_value").alias("value")))
        place = F.shiftright("rank", max(0, n.bit_length() - 2 * BITS)).alias(f"{name}_at")
        groups = groups.join(bounded(ranks.select(F.col("value").alias(f"{name}_value"), place), n, 200), f"{name}_value").drop(f"{name}_value")
    at = F.least((F.log2("size") * (1 << (2 * BITS - 6))).cast("long"), F.lit((1 << 2 * BITS) - 1))
    return checkpointed(light.drop("lang_value", "source_value").join(groups, ["text_crc32", "hash"]).withColumn("size_at", at))


def kd_shards(docs: DataFrame, leaves: int | None = None, *, target_bytes: int | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each row of docs (doc_id, text; lang and source if there) in a shard; the shards have nearly equal bytes.

    The tree splits until every leaf has about target_bytes, or until there are
    `leaves` leaves. Returns the columns of `keep` with size (UTF-8 bytes plus 1),
    text_crc32, shard, slot, group_bytes (of all rows with this text) and cut: rows
    with equal texts are in one shard, unless cut is true, which says that they
    exceed a shard's share. A null text has no bytes and counts as equal to the
    empty one; a null or missing lang or source is a value of its own; equal rows
    are told apart by their place; columns may have any name. An empty table gives
    an empty result. Shards stay empty only where there are fewer rows, or fewer
    texts that needn't be cut, than shards, or where a single row or text has more
    than a shard's share. A shard differs from its share by half a group at most for
    each split above it.
    """
    if leaves is None:
        leaves = leaves_for(docs, target_bytes)
    placed = checkpointed(assign(coordinates(docs, keep), leaves))
    return number_slots(placed).select("kept.*", "size", "text_crc32", "shard", "slot", "group_bytes", "cut")


def leaves_for(docs: DataFrame, target_bytes: int) -> int:
    """Number of leaves at which they have target_bytes on average at most."""
    return max(1, -(-total_bytes(docs) // target_bytes))


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(utf8_size(F.col("text")) + 1)).first()[0] or 0
