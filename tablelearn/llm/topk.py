"""Exact top-k inner-product search with trees of covering radii over queries and data.

Vectors become whole numbers, floor(256 x).  All rows go to the nearest of a bounded number of
pivots; a cell knows its radius, and cells are cut into blocks of bounded size.  The
first pass searches every query in one block of its own cell, which gives a lower bound
of its k-th score.  The second pass sends a query to the blocks of all cells
whose bound (pivot product + radius x query length) reaches that score.  In a block both
sides are indexed: a tree of points, each node covered by a ball around its centre, its
children within half the radius where eight to sixteen of them suffice.  Node pairs are
visited best bound first and pruned when the bound

    <q, p> + rq |p| + rp |q| + rq rp

cannot reach the worst k-th score of the query node.  A block's data are read once, its queries
stream past in groups, so memory is bounded whatever the number of queries.

Defined results: rows with a null id, a null vector or a null or non-finite component take no
part; a repeated row (same id and vector) counts once; rows that share a query's
id are its own row and no candidates for it; an id with several vectors is a query
with each; shorter vectors count as padded with zeros; ties go to the smaller id;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SCALE = 256
LEAF = 128
CHILDREN = 16
MAX_CELLS = 256  # pivots that go to the driver and to all tasks
QUERY_GROUP = 512
LOWEST = -(1 << 62)


def fits_doubles(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether doubles hold every partial sum of the inner products exactly."""
    return float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, x.shape[1]) < 2**53


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of x with all rows of y."""
    if fits_doubles(x, y):
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    exact = x.astype(object) @ y.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Node:
    __slots__ = ("centre", "norm", "radius", "rows", "children")


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, centre: np.ndarray | None = None) -> Node:
    """Tree over the rows of x (doubles); a leaf holds at most LEAF rows, or equal ones."""
    rows = np.arange(len(x)) if rows is None else rows
    node = Node()
    node.centre = x[rows].mean(0) if centre is None else centre
    node.norm = float(np.sqrt(node.centre @ node.centre))
    d = np.sqrt(((x[rows] - node.centre) ** 2).sum(1))
    node.radius = float(d.max()) * (1 + 1e-9)
    node.rows, node.children = rows, []
    if len(rows) <= LEAF or node.radius == 0:
        return node
    # farthest-first centres until all rows are within half the radius, or there are enough children
    near, owner, at = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64), int(d.argmax())
    for c in range(CHILDREN):
        e = np.sqrt(((x[rows] - x[rows[at]]) ** 2).sum(1))
        closer = e < near
        near[closer], owner[closer] = e[closer], c
        at = int(near.argmax())
        if near[at] <= node.radius / 2 and c or near[at] == 0:
            break
    groups = [rows[owner == c] for c in range(int(owner.max()) + 1)]
    if sum(len(g) > 0 for g in groups) > 1:
        node.children = [cover_tree(x, g) for g in groups if len(g)]
    return node


def search(q: np.ndarray, q_ids: np.ndarray, least: np.ndarray, x: np.ndarray, ids: np.ndarray, tree: Node, k: int,
           ) -> list[tuple[int, int, int]]:
    """(query row, data id, score) of each query's k best in the block, as far as they reach ``least``."""
    qf, xf, exact = q.astype(np.float64), x.astype(np.float64), fits_doubles(q, x)
    qtree = cover_tree(qf)
    kth = least.astype(np.float64).copy()
    found: list[list[tuple[int, int]]] = [[] for _ in range(len(q))]  # (score, -id), a heap of k

    def bound(a: Node, b: Node) -> float:
        s = float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return s + 1e-9 * (abs(s) + (a.norm + a.radius) * (b.norm + b.radius)) + 1e-6

    todo = [(-bound(qtree, tree), 0, qtree, tree)]
    number = 1
    while todo:
        up, _, a, b = heapq.heappop(todo)
        if -up < kth[a.rows].min():
            continue
        if not a.children and not b.children:
            s = qf[a.rows] @ xf[b.rows].T if exact else products(q[a.rows], x[b.rows])
            for r, j in zip(*np.nonzero(s >= kth[a.rows, None])):
                i, other = a.rows[r], int(ids[b.rows[j]])
                if other == q_ids[i]:
                    continue
                item, heap = (int(s[r, j]), -other), found[i]
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
                if len(heap) == k:
                    kth[i] = max(kth[i], heap[0][0])
            continue
        split_a = a.children and (not b.children or a.radius >= b.radius)
        for x_, y_ in ([(c, b) for c in a.children] if split_a else [(a, c) for c in b.children]):
            up = bound(x_, y_)
            if up >= kth[x_.rows].min():
                heapq.heappush(todo, (-up, number, x_, y_))
                number += 1
    return [(i, -neg, s) for i, heap in enumerate(found) for s, neg in heap]


def _stack(raw: list[bytes], width: int = 0) -> np.ndarray:
    rows = [np.frombuffer(r, np.int64) for r in raw]
    out = np.zeros((len(rows), max([width, *map(len, rows)])), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _joined(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = max(x.shape[1], y.shape[1])
    return tuple(np.pad(z, ((0, 0), (0, w - z.shape[1]))) for z in (x, y))


def top_k(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", is_query=None, k: int = 5,
          block: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for each row where ``is_query`` holds."""
    spark = rows.sparkSession
    with Scratch(spark, "top-k") as own:
        usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(
            vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        whole = F.transform(vector, lambda v: F.floor(v.cast("double") * SCALE))
        base = rows.where(usable).select(F.col(key).cast("long").alias("id"), whole.alias("w"), (
            F.lit(True) if is_query is None else is_query).alias("query"))

        def encode(batches):
            for b in batches:
                raw = [np.array(w, np.int64).tobytes() for w in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), b.column(2)], ["id", "v", "query"])

        points = own.save(base.mapInArrow(encode, "id long, v binary, query boolean").distinct())
        n = points.count()
        block = block or min(8192, max(1024, n // 16))
        order = [F.xxhash64("id", "v"), "id", "v"]
        pivots = [r["v"] for r in points.orderBy(*order).limit(min(MAX_CELLS, -(-n // block))).collect()]
        if not pivots:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        centres = _stack(pivots)

        def assign(batches):
            for b in batches:
                x, c = (z.astype(np.float64) for z in _joined(_stack(b.column(1).to_pylist()), centres))
                d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 0))
                cell = d.argmin(1)
                exact = np.sqrt(((x - c[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(exact)],
                                                 ["id", "v", "query", "cell", "d"])

        placed = own.save(points.mapInArrow(assign, "id long, v binary, query boolean, cell int, d double"))
        stats = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("r")).collect()}
        cells = np.array(sorted(stats))
        radius = np.array([stats[c]["r"] for c in cells])
        parts = {int(c): -(-stats[c]["n"] // block) for c in cells}
        of_cell = F.create_map(*[F.lit(x) for c in cells for x in (int(c), parts[int(c)])])[F.col("cell")]
        data = placed.select("cell", F.pmod(F.xxhash64("id", "v"), of_cell).cast("int").alias("part"), F.lit(0).alias("side"),
                             F.lit(0).alias("home"), "id", "v", F.lit(LOWEST).cast("long").alias("least"))
        queries = placed.where("query")
        own_block = queries.select("cell", F.pmod(F.xxhash64("id", "v"), of_cell).cast("int").alias("part"), F.lit(1).alias("side"),
                                   F.col("cell").alias("home"), "id", "v", F.lit(LOWEST).cast("long").alias("least"))
        names = ["cell", "part", "side", "home", "id", "v", "least"]

        def searched(streams: DataFrame) -> DataFrame:
            """One partition of the shuffle holds whole blocks: first a block's data, then its queries."""
            parts_n = max(1, min(4096, sum(parts.values())))
            dealt = streams.repartition(parts_n, "cell", "part").sortWithinPartitions("cell", "part", "side", "home")

            def run(batches):
                at, data_rows, tree, x, ids, waiting = None, [], None, None, None, []

                def answer():
                    nonlocal tree, x, ids
                    if not waiting or not data_rows:
                        waiting.clear()
                        return None
                    if tree is None:
                        x, ids = _stack([r[1] for r in data_rows]), np.array([r[0] for r in data_rows], np.int64)
                        tree = cover_tree(x.astype(np.float64))
                    q, y = _joined(_stack([w[1] for w in waiting]), x)
                    if y.shape[1] != x.shape[1]:
                        tree, x = cover_tree(y.astype(np.float64)), y
                    hits = search(q, np.array([w[0] for w in waiting], np.int64), np.array([w[2] for w in waiting], np.int64),
                                  x, ids, tree, k)
                    out = pa.RecordBatch.from_arrays(
                        [pa.array([waiting[i][0] for i, _, _ in hits], pa.int64()), pa.array([waiting[i][1] for i, _, _ in hits], pa.binary()),
                         pa.array([j for _, j, _ in hits], pa.int64()), pa.array([s for _, _, s in hits], pa.int64())],
                        ["query_id", "qv", "vec_id", "score"])
                    waiting.clear()
                    return out

                for b in batches:
                    cols = [b.column(j).to_pylist() for j in range(7)]
                    for cell, part, side, _, i, v, least in zip(*cols):
                        if (cell, part) != at:
                            if (out := answer()) is not None:
                                yield out
                            at, data_rows, tree = (cell, part), [], None
                        if side == 0:
                            data_rows.append((i, v))
                        else:
                            waiting.append((i, v, least))
                            if len(waiting) >= QUERY_GROUP and (out := answer()) is not None:
                                yield out
                if (out := answer()) is not None:
                    yield out

            return dealt.mapInArrow(run, "query_id long, qv binary, vec_id long, score long")

        best = Window.partitionBy("query_id", "qv").orderBy(F.desc("score"), "vec_id")
        first = searched(data.select(*names).unionByName(own_block.select(*names)))
        seeds = own.save(first.groupBy(F.col("query_id").alias("_id"), F.col("qv").alias("_v")).agg(
            F.count("*").alias("c"), F.min("score").alias("s")).where(F.col("c") >= k).select("_id", "_v", "s"))
        seeded = queries.join(seeds, (F.col("id") == F.col("_id")) & (F.col("v") == F.col("_v")), "left").select(
            "id", "v", "cell", F.coalesce("s", F.lit(LOWEST)).alias("least"))
        part_of = np.array([parts[int(c)] for c in cells])

        def reach(batches):
            for b in batches:
                x, c = (z.astype(np.float64) for z in _joined(_stack(b.column(1).to_pylist()), centres))
                norm = np.sqrt((x * x).sum(1))
                s = x @ c[cells].T + norm[:, None] * radius[None, :]
                s += 1e-9 * (np.abs(s) + norm[:, None] * (radius + np.sqrt((c[cells] ** 2).sum(1)))) + 1e-6
                i, j = np.nonzero(s >= np.array(b.column(3).to_pylist(), np.float64)[:, None])
                i, j, part = (np.repeat(z, part_of[j]) for z in (i, j, j))
                if len(i):
                    run = np.arange(len(i)) - np.searchsorted(_runs(i, j), _runs(i, j))
                    at = pa.array(i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[j].astype(np.int32)), pa.array(run.astype(np.int32)), pa.array(np.ones(len(i), np.int32)),
                         b.column(2).take(at), b.column(0).take(at), b.column(1).take(at), b.column(3).take(at)], names)

        sent = seeded.mapInArrow(reach, "cell int, part int, side int, home int, id long, v binary, least long")
        hits = searched(data.select(*names).unionByName(sent))
        ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return own.save(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), keep=True)


def _runs(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Numbers the runs of equal (i, j), which stand together."""
    return np.cumsum(np.append(0, (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
