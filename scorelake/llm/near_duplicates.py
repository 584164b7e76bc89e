"""MinHash near-duplicate detection.

Many universal hash minima per document are cut into bands; documents that
share a band are candidates. Candidates pass a signature check and then an
exact comparison of their full shingle sets. Links that hold are turned into
components by alternating large-star and small-star steps.

No bucket is expanded into all its pairs. Texts with equal shingle sets are one
node from the start. In every bucket the members are first compared with one
pivot; after the components of these links are known, only members of different
components of a bucket are compared with each other. In a large bucket the most
frequent component is the host of all others: its members are sent out once to
meet their guests of all buckets, and only what is left of a bucket without its
host is compared bucket by bucket, both in blocks, which only links that join
components leave.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import bounded, checkpointed, prepare_python

#: Hash minima of a signature, and the chance at which a pair at the threshold may share no band.
MINIMA, MISS = 336, 1e-7
#: Members up to which a bucket's remaining pairs come from a join; larger buckets are compared in blocks of about BLOCK members and BLOCK_BYTES of sets.
JOINED, BLOCK, BLOCK_BYTES = 12, 512, 4 << 20
#: Edges of a node from which on its joins are made splittable.
HOT_EDGES = 500_000
_rng = np.random.default_rng(8551)
_A, _B = _rng.integers(0, 2**64, (2, MINIMA), dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash over a set of shingles.

    The hashes are (a*x+b modulo 2**64) >> 32 of the high 32 bits of a shingle,
    which is a strongly universal family.
    """
    x = shingles >> np.uint64(32)
    low = np.full(len(_A), 2**64 - 1, np.uint64)
    for k in range(0, len(x), 64):
        h = x[k : k + 64, None] * _A
        h += _B
        np.minimum(low, h.min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def short_signature(low: np.ndarray) -> np.ndarray:
    """A byte for each minimum; different minima have equal bytes by a chance of 1 in 256."""
    return (textops.mix(low + np.arange(len(low), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


def rows_of_band(percent: int) -> int:
    """The most minima of a band at which a pair at the threshold is missed with a chance of MISS at most."""
    return max((r for r in range(1, 17) if (1 - (percent / 100) ** r) ** (MINIMA // r) <= MISS), default=1)


def band_keys(low: np.ndarray, rows: int) -> np.ndarray:
    """For each signature (row) a key of each band."""
    bands = MINIMA // rows
    parts = low[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
    total = np.zeros(parts.shape[:2], np.uint64)
    for k in range(rows):
        total = textops.mix(total * np.uint64(31) + parts[:, :, k] + np.uint64(k + 1))
    return textops.mix(total + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    """A content hash of a shingle set; equal sets have equal nodes."""
    return int(textops.mix(np.array([np.add.reduce(textops.mix(shingles ^ np.uint64(0xA5A5A5A5))) + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _sets(texts: list[bytes | None], width: int) -> Iterator[tuple[int, np.ndarray]]:
    for low, high in textops.packets(texts):
        _, _, _, hashes, first = textops.words([t or b"" for t in texts[low:high]], fold=True)
        for i in range(high - low):
            yield low + i, textops.shingles(hashes[first[i] : first[i + 1]], width)


def _describe(width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes, nodes, lows, full = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
            for i, s in _sets(textops.as_bytes(batch.column("text")), width):
                sizes[i] = len(s)
                if len(s):
                    nodes[i] = node_of(s)
                    lows.append(signature(s))
                    full.append(i)
            keys = band_keys(np.array(lows), rows).ravel() if lows else np.zeros(0, np.int64)
            ends = np.zeros(n + 1, np.int32)
            ends[np.array(full, int) + 1] = MINIMA // rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), pa.array(nodes, mask=sizes == 0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys))],
                names=["doc_id", "tkey", "node", "n_shingles", "bands"],
            )

    return run


def _full_sets(width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sigs, keys, sets = [], [], [], []
            for _, s in _sets(textops.as_bytes(batch.column("text")), width):
                if len(s):
                    nodes.append(node_of(s))
                    low = signature(s)
                    sigs.append(short_signature(low).tobytes())
                    keys.append(band_keys(low[None], rows).tobytes())
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["node", "sig", "keys", "shingles"])

    return run


def _least_agreement(percent: int) -> float:
    """Agreement of signatures, six standard deviations below what pairs at the threshold show: with independent hashes one link in 10**9 at the threshold lies below."""
    j = percent / 100
    return j - 6 * math.sqrt(j * (1 - j) / len(_A))


def _agreeing(percent: int):
    """Keep the pairs whose signatures agree well enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = _least_agreement(percent)
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in ("sig_a", "sig_b"))
                keep = pa.array((x == y).mean(axis=1) >= floor)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two shingle sets reach the threshold."""
    both = len(x) + len(y)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = both - len(np.unique(np.concatenate((x, y))))
    return 100 * common >= percent * (both - common)


def _similar(percent: int):
    """Keep the pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("set_a"), batch.column("set_b")
            keep = pa.array([_linked(np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64), percent) for i in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def _joined(pairs: DataFrame, sets: DataFrame, column: str, short: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col(column).alias(f"{short}_{side}")), side)
    return pairs.select("a", "b", f"{short}_a", f"{short}_b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links; pairs without repetition."""
    likely = _joined(pairs, sets, "sig", "sig").mapInArrow(textops.released(_agreeing(percent)), "a long, b long")
    return checkpointed(_joined(likely, sets, "shingles", "set").mapInArrow(textops.released(_similar(percent)), "a long, b long"))


def _block_links(percent: int):
    """Links between two blocks (or within one) that join components; at most one for each that is joined.

    A host and a guest are compared if they share any bucket. Members of one bucket
    are compared in the first bucket that they share, and nowhere else.
    """

    def run(key: tuple, group: pa.Table) -> pa.Table:
        floor = _least_agreement(percent)
        hosted, bucket, lo, hi = (k.as_py() for k in key)
        nodes, comps, block = (group.column(k).to_numpy() for k in ("node", "comp", "block"))
        sigs, keys = (np.frombuffer(b"".join(group.column(k).to_pylist()), t).reshape(len(nodes), -1) for k, t in (("sig", np.uint8), ("keys", np.int64)))
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        before = 0 if hosted else int(np.flatnonzero(keys[0] == bucket)[0])
        left, right, comps, found = np.flatnonzero(block == hi), np.flatnonzero(block == lo), comps.copy(), []
        for i in left:
            other = right[(comps[right] != comps[i]) & ((nodes[right] > nodes[i]) if lo == hi else True)]
            other = other[(sigs[other] == sigs[i]).mean(axis=1) >= floor]
            shared = (keys[other] if hosted else keys[other, :before]) == (keys[i] if hosted else keys[i, :before])
            for j in other[shared.any(axis=1) == hosted]:
                if comps[j] != comps[i] and _linked(sets[i], sets[j], percent):
                    found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                    comps[comps == comps[j]] = comps[i]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b); the component is its least node.

    Alternates large-star and small-star until the edges stay as they are.
    Minima are aggregated before the shuffle and joined back. Where a node has more
    than HOT_EDGES edges they are written before the join, which then has a plain
    shuffle on both sides, so adaptive execution splits the node's partition. An
    edge from a node to itself, a repeated edge and an empty table are allowed.
    """
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def mark(df: DataFrame) -> tuple:
        """Number and checksum of the edges, and the most of one node."""
        return tuple(df.groupBy("v").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).agg(F.sum("n"), F.bit_xor("x"), F.max("n")).first())

    seen = mark(now)
    while seen[0]:
        written = checkpointed if seen[2] > HOT_EDGES else lambda df: df
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = written(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        if (found := mark(now)) == seen:
            break
        seen = found
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _open_rows(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (band, node, size, members, comp) of the buckets that hold more than one component, with the most frequent one as host."""
    placed = checkpointed(members.join(labels, "node", "left").select("band", "node", "members", "size", F.coalesce("component", "node").alias("comp")))
    held = placed.groupBy("band", "comp").agg(F.count("*").alias("n")).groupBy("band").agg(F.max(F.struct("n", "comp"))["comp"].alias("host"), F.count("*").alias("comps"))
    return checkpointed(placed.join(checkpointed(held.filter("comps > 1").drop("comps")), "band"))


def _blocks(rows: DataFrame, hosted: bool) -> DataFrame:
    """Rows (bucket, node, size, comp, guest) dealt to blocks, once for each pair of blocks in which they are compared.

    Hosts meet guests only; guests meet hosts, and without hosts each other.
    """
    many = lambda mine: F.ceil(F.greatest(F.count_if(mine) / BLOCK, F.sum(F.when(mine, F.col("size"))) * 8 / BLOCK_BYTES)).cast("int")
    plan = checkpointed(rows.groupBy("bucket").agg(F.coalesce(many(~F.col("guest")), F.lit(0)).alias("hosts"), F.coalesce(many(F.col("guest")), F.lit(0)).alias("guests")))
    dealt = rows.join(plan, "bucket").withColumn("block", F.when(F.col("guest"), F.col("hosts") + F.pmod(F.xxhash64("node"), "guests")).otherwise(F.pmod(F.xxhash64("node"), "hosts")).cast("int"))
    meets = F.when(F.col("guest") & F.lit(hosted), F.sequence(F.lit(0), F.col("hosts") - 1)).otherwise(F.sequence(F.col("hosts"), F.col("hosts") + F.col("guests") - 1))
    dealt = dealt.withColumn("other", F.explode(meets))
    return dealt.select(F.lit(hosted).alias("hosted"), "bucket", "node", "comp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def near_duplicates(docs: DataFrame, *, percent: int = 85, width: int = 5) -> DataFrame:
    """Components of near-duplicate documents of docs (doc_id, text; other columns are ignored).

    Returns one row per input row: doc_id, n_shingles, component_id (the least
    doc_id of the component), kept (doc_id is component_id), tkey (xxhash64 of the
    text) and first (whether the text is the one that stands for its component). A
    null or empty text has no shingles and is a component by itself; a repeated row
    joins its twin; a null doc_id counts as larger than all others and is kept only
    where its component has no other. An empty table gives an empty result. Memory:
    a Python worker holds the sets of one packet of texts, of the pairs of one Arrow
    batch, or of two blocks of a bucket. Buckets, nodes and components with very
    many rows are joined by plain shuffles on both sides, whose partitions adaptive
    execution splits.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("tkey"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    described = checkpointed(source.mapInArrow(textops.released(_describe(width, rows_of_band(percent))), f"doc_id {id_type}, tkey long, node long, n_shingles long, bands array<long>"))

    classes = checkpointed(described.filter("node is not null").groupBy("node").agg(F.min("tkey").alias("tkey"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands")))
    rows = classes.select("node", "size", F.explode("bands").alias("band"))
    pivots = checkpointed(rows.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("hi"), F.count("*").alias("members")).filter("pivot <> hi").drop("hi"))
    members = checkpointed(rows.join(pivots, "band"))

    wanted = checkpointed(members.select("node").distinct().join(classes.select("node", "tkey"), "node").select("tkey"))
    texts = source.join(bounded(wanted, wanted.count(), 16), "tkey", "left_semi").select("text")
    sets = checkpointed(texts.mapInArrow(textops.released(_full_sets(width, rows_of_band(percent))), "node long, sig binary, keys binary, shingles binary").groupBy("node").agg(*[F.first(c).alias(c) for c in ("sig", "keys", "shingles")]))

    stars = members.filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = _verified(stars, sets, percent)
    labels = checkpointed(connected_components(links))
    open_rows = _open_rows(members, labels)
    few = open_rows.filter(F.col("members") <= JOINED)
    other = few.select("band", F.col("node").alias("node2"), F.col("comp").alias("comp2"))
    pairs = few.join(other, "band").filter("comp <> comp2 and node < node2").select(F.col("node").alias("a"), F.col("node2").alias("b"))
    large = open_rows.filter(F.col("members") > JOINED).withColumn("guest", F.col("comp") != F.col("host"))
    meeting = checkpointed(large.select(F.col("host").alias("bucket"), "node", "size", "comp", "guest").distinct())
    left = large.filter("guest")
    mixed = checkpointed(left.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band"))
    left = checkpointed(left.join(mixed, "band").select(F.col("band").alias("bucket"), "node", "size", "comp", "guest"))
    blocks = _blocks(meeting, True).union(_blocks(left, False)).join(sets, "node")
    joining = blocks.groupBy("hosted", "bucket", "lo", "hi").applyInArrow(_block_links(percent), "a long, b long")
    rest = pairs.distinct().join(stars, ["a", "b"], "left_anti")
    more = checkpointed(_verified(rest, sets, percent).union(joining))

    known_stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = labels if more.isEmpty() else checkpointed(connected_components(known_stars.union(more)))
    owners = described.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    known = owners.join(final, "node", "left").select("node", "low", F.coalesce("component", "node").alias("component"))
    named = checkpointed(known.groupBy("component").agg(F.min(F.struct(F.col("low").isNull().alias("none"), "low", "node")).alias("best")))
    chosen = known.join(named, "component").select("node", F.col("best.low").alias("component_id"), (F.col("node") == F.col("best.node")).alias("first"))
    out = described.select("doc_id", "n_shingles", "node", "tkey").join(chosen, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "tkey", F.coalesce("first", F.lit(True)).alias("first"))


def deduplicate(docs: DataFrame, *, percent: int = 85, width: int = 5) -> DataFrame:
    """One row of docs for each component: that of its least doc_id; all columns as they were.

    Rows without shingles all stay. Of rows with the same id in a component one
    text stays, and of repeated rows one. Only what has to go, or what occurs
    repeatedly, is joined to the texts.
    """
    found = checkpointed(near_duplicates(docs, percent=percent, width=width))
    rows = found.groupBy("doc_id", "tkey").agg(F.max(F.col("kept") & F.col("first")).alias("stays"), (F.count("*") * F.max(F.when(F.col("n_shingles") > 0, 1).otherwise(0))).alias("times"))
    marks = checkpointed(rows.filter("not stays or times > 1").withColumnsRenamed({"doc_id": "marked_id", "tkey": "marked_text"}))
    size = marks.agg(F.count("*"), F.max("times")).first()
    same = F.col("doc_id").eqNullSafe(F.col("marked_id")) & F.col("tkey").eqNullSafe(F.col("marked_text"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("tkey"))
    stay = whole.join(bounded(marks, size[0], 64), same, "left").filter(F.coalesce("stays", F.lit(True)))
    if (size[1] or 0) > 1:
        once = F.coalesce("times", F.lit(1)) <= 1
        stay = stay.filter(once).union(stay.filter(~once).dropDuplicates(["doc_id", "tkey"]))
    return stay.select("row.*")
