"""Nearest neighbours by inner product with vantage-point trees per shard.

Vectors are dealt to cells, each around a pivot, and a cell is cut into shards of
bounded size. Every shard is indexed once: its vectors get one more component,
sqrt(M**2 - |x|**2) for the largest norm M of the shard, so that the largest inner
product is the least Euclidean distance, and a vantage-point tree is built on them.

A query first searches one shard of its own cell. The k-th inner product found
there bounds its other searches: a cell with pivot p and radius r is left out if
q.p + factor * |q| * r lies below it, and a subtree whose distances from its
vantage point lie in [lo, hi] is left out if the triangle inequality puts it
beyond factor times the distance of the k-th neighbour. With factor one nothing
nearer is ever left out; below one searches skip more and may miss neighbours.
What is compared with a bound has a slack in proportion to the norms, and
neighbours are ranked by inner products of the vectors themselves.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops
from .common import bounded, checkpointed, prepare_python

#: Rows of a shard, rows of a leaf of its tree, queries that meet a shard in one task, and queries that go down a tree together.
SHARD, LEAF, BLOCK, TOGETHER = 8192, 512, 16384, 2048
#: Most cells; and vectors for each cell, and bytes, of the sample that places the pivots.
CELLS, SAMPLE, SAMPLE_BYTES = 1024, 64, 16 << 20
#: Share of the norms by which computed distances may be wrong: the root of the rounding error of their squares, and some more.
SLACK = 1e-7
#: Largest components outside of this range are scaled by a power of two, lest squares overflow.
RANGE = (1e-100, 1e100)

_KEY = "size int, cell int, part int"


def build(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list]:
    """Order of the points and the nodes of a vantage-point tree.

    A node is (begin, end) of its points in the order and, unless it is a leaf, the
    point at its begin as the vantage point with [(child, lo, hi), (child, lo, hi)].
    """
    order, nodes, todo = np.arange(len(points)), [], [(0, len(points), None, 0)]
    while todo:
        begin, end, parent, side = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][2][side][0] = me
        if end - begin <= leaf:
            nodes.append((begin, end, None))
            continue
        part = order[begin:end]
        centre = points[part].mean(axis=0)
        far = int(((points[part] - centre) ** 2).sum(axis=1).argmax())  # a point at the border separates best
        part[[0, far]] = part[[far, 0]]
        away = np.sqrt(((points[part[1:]] - points[part[0]]) ** 2).sum(axis=1))
        by = np.argsort(away, kind="stable")
        part[1:], away = part[1:][by], away[by]
        half = len(away) // 2
        nodes.append((begin, end, [[None, away[0], away[half - 1]], [None, away[half], away[-1]]]))
        todo += [(begin + 1, begin + 1 + half, me, 0), (begin + 1 + half, end, me, 1)]
    return order, nodes


def raised(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The points with the component that makes all of them as long as the longest, and that length."""
    squares = (x**2).sum(axis=1)
    top = float(squares.max(initial=0))
    return np.column_stack((x, np.sqrt(np.maximum(top - squares, 0)))), math.sqrt(top)


def search(x: np.ndarray, norm: float, order: np.ndarray, nodes: list, queries: np.ndarray, k: int, factor: float = 1.0, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) that hold all points that can be among the k best of each query.

    least: for each query an inner product of which enough points are known
    elsewhere; only points that reach it matter.
    """
    squares = (queries**2).sum(axis=1)
    reach = np.sqrt(squares + norm**2)
    slack, rounding = SLACK * reach, 1e-15 * (x.shape[1] + 8) * np.sqrt(squares) * norm
    best = np.full((len(queries), k), -np.inf)
    least = np.full(len(queries), -np.inf) if least is None else least.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def tidy() -> None:
        nonlocal held
        if found:
            q, p, s = (np.concatenate(c) for c in zip(*found, strict=True))
            keep = s >= least[q] - rounding[q]
            found[:] = [(q[keep], p[keep], s[keep])]
            held = 2 * int(keep.sum())

    def look(rows: np.ndarray, some: np.ndarray) -> None:
        nonlocal held
        s = queries[rows] @ x[some].T
        top = np.concatenate((best[rows], s), axis=1)
        best[rows] = -np.partition(-top, k - 1, axis=1)[:, :k]
        least[rows] = np.maximum(least[rows], best[rows].min(axis=1))
        q, p = np.nonzero(s >= (least[rows] - rounding[rows])[:, None])
        found.append((rows[q], some[p], s[q, p]))
        held += len(q)
        if held > 1 << 21:
            tidy()

    def down(node: int, rows: np.ndarray) -> None:
        """Every query goes first into the child that is nearer to it; then into the other one unless that is skipped."""
        begin, end, children = nodes[node]
        if children is None:
            look(rows, order[begin:end])
            return
        look(rows, order[begin : begin + 1])
        d = np.sqrt(np.maximum(squares[rows] + norm**2 - 2 * (queries[rows] @ x[order[begin]]), 0))
        gaps = [np.maximum(np.maximum(d - hi, lo - d) - 2 * slack[rows], 0) for _, lo, hi in children]
        first = (gaps[1] < gaps[0]).astype(int)
        for turn in (0, 1):
            for side in (0, 1):
                mine = (first == side) if turn == 0 else (first != side)
                kth = np.sqrt(np.maximum(squares[rows] + norm**2 - 2 * least[rows], 0))
                mine &= gaps[side] <= factor * (kth + slack[rows])
                if mine.any():
                    down(children[side][0], rows[mine])

    if len(x) and len(queries):
        down(0, np.arange(len(queries)))
        tidy()
    return found[0][:2] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _vectors(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), size)


def place_pivots(sample: np.ndarray, cells: int) -> np.ndarray:
    """Pivots from a sample: its first vectors, moved to the middle of what is nearest to them a few times."""
    pivots = sample[:cells].copy()
    for _ in range(5):
        near = nearest(sample, pivots)
        for k in range(len(pivots)):
            if (mine := near == k).any():
                pivots[k] = sample[mine].mean(axis=0)
    return pivots


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return ((pivots**2).sum(axis=1) - 2 * (x @ pivots.T)).argmin(axis=1)


def _cells(pivots: dict[int, np.ndarray]):
    """Add the cell of each vector, and its distance from the pivot."""

    def run(batches):
        for batch in batches:
            size = batch.column("size").to_numpy()
            cell, away = np.zeros(len(size), np.int32), np.zeros(len(size))
            for d in np.unique(size):
                mine = np.flatnonzero(size == d)
                x = _vectors(batch.column("v").take(pa.array(mine)), int(d))
                cell[mine] = nearest(x, pivots[d])
                away[mine] = np.sqrt(((x - pivots[d][cell[mine]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "cell", "away"])

    return run


def _index(k: int):
    """The index of a shard. Of equal vectors the k + 1 with the least ids can be among the nearest, the others can't."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        x = _vectors(group.column("v"), key[0].as_py())
        same = np.unique(x, axis=0, return_inverse=True)[1].ravel()
        by = np.argsort(same, kind="stable")
        first = np.searchsorted(same[by], same[by])
        keep = np.sort(by[np.arange(len(by)) - first <= k])
        x, ids = x[keep], group.column("vec_id").take(pa.array(keep))
        points, norm = raised(x)
        order, nodes = build(points)
        whole = {"x": x, "norm": norm, "order": order, "nodes": nodes, "row": group.column("row").to_numpy()[keep], "id": ids.fill_null(0).to_numpy(), "none": ids.is_null().to_numpy()}
        return pa.table({"size": pa.array([key[0].as_py()], pa.int32()), "cell": pa.array([key[1].as_py()], pa.int32()), "part": pa.array([key[2].as_py()], pa.int32()), "shard": pa.array([pickle.dumps(whole)], pa.binary())})

    return run


def _search_shard(k: int, factor: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            s = pickle.loads(left.column("shard")[0].as_py())
            queries, own = _vectors(right.column("v"), s["x"].shape[1]), right.column("row").to_numpy()
            least = right.column("least").to_numpy(zero_copy_only=False).astype(float)
            for low in range(0, len(queries), TOGETHER):
                some = slice(low, low + TOGETHER)
                q, p = search(s["x"], s["norm"], s["order"], s["nodes"], queries[some], k + 1, factor, least[some])
                q = q + low
                other = own[q] != s["row"][p]
                q, p = q[other], p[other]
                score = np.concatenate([np.zeros(0), *((s["x"][p[i : i + 65536]] * queries[q[i : i + 65536]]).sum(axis=1) for i in range(0, len(p), 65536))])
                by = np.lexsort((s["row"][p], s["id"][p], s["none"][p], -score, q))
                q, p, score = q[by], p[by], score[by]
                top = np.arange(len(q)) - np.searchsorted(q, q) < k
                out.append((q[top], p[top], score[top]))
        q, p, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
        take = lambda name: s[name][p] if out else np.zeros(0, np.int64)
        return pa.table({
            "query_row": pa.array(own[q] if out else q, pa.int64()), "query_id": right.column("vec_id").take(pa.array(q)) if out else pa.array([], pa.int64()),
            "row": pa.array(take("row"), pa.int64()), "vec_id": pa.array(take("id"), pa.int64(), mask=take("none").astype(bool)), "score": pa.array(score, pa.float64()),
        })

    return run


def _wanted(pivots: dict[int, np.ndarray], radius: dict[int, np.ndarray], factor: float):
    """For each query the cells that can hold one of its neighbours; its own cell is among them."""

    def run(batches):
        for batch in batches:
            size, least = batch.column("size").to_numpy(), batch.column("least").to_numpy(zero_copy_only=False).astype(float)
            cells: list[list[int]] = [[]] * len(size)
            for d in np.unique(size):
                mine = np.flatnonzero(size == d)
                q = _vectors(batch.column("v").take(pa.array(mine)), int(d))
                long = np.sqrt((q**2).sum(axis=1))[:, None]
                most = q @ pivots[d].T + long * radius[d] * factor
                slack = 1e-14 * (d + 8) * long * (np.sqrt((pivots[d] ** 2).sum(axis=1)) + radius[d])
                for i, fit in zip(mine, most + slack >= least[mine][:, None], strict=True):
                    cells[i] = np.flatnonzero(fit).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    return run


def neighbours(vectors: DataFrame, *, k: int = 20, every: int = 20, factor: float = 1.0, shard_rows: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The k nearest rows by inner product for every row whose vec_id is divisible by `every`.

    vectors has vec_id and embedding; other columns are ignored. Returns query_id,
    rank, vec_id, score: nearest first, ties to the smaller vec_id (null last), a
    query's own row left out. Null vectors, vectors with a null, infinite or NaN
    component, and zero vectors take no part; vectors of different lengths are
    not compared. Repeated rows are rows of their own, also as queries. Fewer
    candidates than k give fewer rows, an empty table none. factor=1 is exact for
    any norms. A task holds one shard and one block of queries. A cell with a third
    of all vectors has as many shards as it needs; equal vectors spread over them.
    The driver holds the pivots (CELLS for each length of vectors, placed by a
    sample of SAMPLE_BYTES) and a number for each cell.
    """
    prepare_python(vectors.sparkSession)
    v = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.col("embedding").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"), F.monotonically_increasing_id().alias("row"))
    rows = checkpointed(rows.filter("sound").drop("sound").withColumn("size", F.size("v")).withColumn("deal", F.xxhash64("vec_id", "row")))
    query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    stats = rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if(query).alias("q"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).collect()  # a row for each length of vectors
    largest = max((r["most"] for r in stats), default=1.0)
    scale = 1.0 if RANGE[0] <= largest <= RANGE[1] else 2.0 ** math.floor(math.log2(largest))
    if scale != 1:
        rows = rows.withColumn("v", F.transform("v", lambda x: x / scale))
    cells = {r["size"]: max(1, min(CELLS, -(-r["n"] // shard_rows))) for r in stats}
    share = {r["size"]: min(1.0, min(SAMPLE * cells[r["size"]], max(cells[r["size"]], SAMPLE_BYTES // (8 * r["size"]))) / r["n"]) for r in stats}
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "deal"), F.lit(1 << 30)) < F.element_at(F.create_map(*[F.lit(x) for s, p in (share or {0: 0.0}).items() for x in (s, int(p * (1 << 30)))]), F.col("size"))
    sample = rows.filter(drawn).select("size", "v").toArrow() if stats else None
    pivots = {}
    for r in stats:
        mine = sample.filter(pa.compute.equal(sample.column("size"), r["size"])).column("v")
        pivots[r["size"]] = place_pivots(_vectors(mine, r["size"]), cells[r["size"]]) if len(mine) else np.zeros((1, r["size"]))

    names = "vec_id long, v array<double>, row long, size int, deal long"
    placed = checkpointed(rows.mapInArrow(textops.released(_cells(pivots)), f"{names}, cell int, away double"))
    counted = checkpointed(placed.groupBy("size", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).withColumn("parts", F.ceil(F.col("n") / shard_rows).cast("int")))
    radius = {s: np.full(len(p), -np.inf) for s, p in pivots.items()}  # an empty cell is wanted by no query
    for r in counted.collect():
        radius[r["size"]][r["cell"]] = r["radius"]
    parts = bounded(counted.select("size", "cell", "parts"), sum(map(len, pivots.values())), 32)
    placed = placed.join(parts, ["size", "cell"]).withColumn("part", F.pmod("deal", "parts").cast("int"))
    index = checkpointed(placed.groupBy("size", "cell", "part").applyInArrow(_index(k), f"{_KEY}, shard binary"))

    blocks = max(1, -(-sum(r["q"] for r in stats) // block))
    queries = placed.filter(query).select("vec_id", "v", "row", "size", "cell", "part", F.pmod(F.xxhash64("deal"), F.lit(blocks)).cast("int").alias("block"))
    key = ["size", "cell", "part", "block"]
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "query_row long, query_id long, row long, vec_id long, score double"
    run = lambda wanted: spread.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(_search_shard(k, factor), schema)
    first = checkpointed(run(queries.withColumn("least", F.lit(float("-inf")))))
    bounds = first.groupBy("query_row").agg(F.count("*").alias("found"), F.min("score").alias("low"))
    known = queries.join(bounds, queries["row"] == bounds["query_row"], "left").withColumn("least", F.when(F.col("found") >= k, F.col("low")).otherwise(float("-inf")))
    known = known.select("vec_id", "v", "row", "size", F.col("cell").alias("own_cell"), F.col("part").alias("own_part"), "block", "least")
    sent = known.mapInArrow(textops.released(_wanted(pivots, radius, factor)), "vec_id long, v array<double>, row long, size int, own_cell int, own_part int, block int, least double, cells array<int>")
    sent = sent.withColumn("cell", F.explode("cells")).drop("cells").join(parts, ["size", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    near = first.union(run(sent.filter("cell <> own_cell or part <> own_part").select("vec_id", "v", "row", "size", "cell", "part", "block", "least")))
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", (F.col("score") * scale * scale).alias("score"))
