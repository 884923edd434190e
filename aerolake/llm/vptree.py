"""Nearest neighbours by inner product, with a vantage-point tree for each shard.

A shard's vectors get one more coordinate that makes their norms equal; then a larger inner
product is a smaller distance, and the triangle inequality holds. A node keeps the range of distances
from its vantage point on either side. A side is left out for a query when its smallest possible
distance times ``factor`` is beyond the k-th best so far: factor 1 is exact, more is faster and misses some.

Products are first made by the matrix product, whose sums have no fixed order; only those that can be among the k
best within its rounding are made again in the order of coordinates.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolake.llm.caps import vector_rows
from aerolake.llm.common import ready, stored

NEAREST = 20
#: Mean vectors of a shard, most vectors of a leaf, queries of a block.
SHARD_ROWS = 4096
LEAF = 64
BLOCK = 2048
FACTOR = 1.0
#: Tasks that trees are dealt to, a tree each while there are no more; bytes of trees that a task holds.
TASKS = 32
HELD = 64 << 20


def products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the order of coordinates: equal vectors get equal products."""
    out = np.zeros((len(queries), len(points)))
    for a, b in zip(queries.T, points.T):
        out += a[:, None] * b[None, :]
    return out


def some_products(queries: np.ndarray, points: np.ndarray, line: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The same for pairs of columns only."""
    out = np.zeros(len(line))
    for a, b in zip(queries, points):
        out += a[line] * b[point]
    return out


class Tree:
    """Nodes are rows: vantage point (or first row of a leaf), end of a leaf, two children, distance ranges."""

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        norms = np.sqrt((points * points).sum(axis=1))
        self.top = float(norms.max(initial=0.0))
        lift = np.sqrt(np.maximum(self.top**2 - norms**2, 0))
        stream = np.random.Generator(np.random.PCG64(len(ids)))
        nodes: list[list[float]] = []
        order: list[int] = []

        def grow(rows: np.ndarray) -> int:
            number = len(nodes)
            nodes.append([0.0] * 8)
            at = len(order)
            if len(rows) <= LEAF:
                order.extend(rows.tolist())
                nodes[number] = [at, at + len(rows), -1, -1, 0, 0, 0, 0]
                return number
            pick = int(stream.integers(len(rows)))
            order.append(int(rows[pick]))
            rest = np.delete(rows, pick)
            same = points[rest] @ points[rows[pick]] + lift[rest] * lift[rows[pick]]
            far = np.sqrt(np.maximum(2 * self.top**2 - 2 * same, 0))
            half = np.argsort(far, kind="stable")
            inner, outer = half[: len(half) // 2], half[len(half) // 2 :]
            ranges = [far[inner].min(), far[inner].max(), far[outer].min(), far[outer].max()]
            left = grow(rest[inner])
            right = grow(rest[outer])
            nodes[number] = [at, at + 1, left, right, *map(float, ranges)]
            return number

        grow(np.arange(len(ids)))
        self.nodes = np.array(nodes)
        self.ids, self.columns = ids[order], np.ascontiguousarray(points[order].T)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, top=self.top, nodes=self.nodes, ids=self.ids, columns=self.columns)
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes) -> Tree:
        tree = Tree.__new__(Tree)
        with np.load(io.BytesIO(data)) as parts:
            tree.top, tree.nodes, tree.ids, tree.columns = float(parts["top"]), parts["nodes"], parts["ids"], parts["columns"]
        return tree

    def search(
        self, own: np.ndarray, queries: np.ndarray, k: int, factor: float, known: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k nearest of each query, best first, -inf where there are fewer; products made.

        ``own`` are the queries' ids, which are no candidates; ``known`` are ids and scores found in other trees.
        """
        bounded = known is not None
        if not bounded:
            known = np.full((len(queries), k), np.iinfo(np.int64).max), np.full((len(queries), k), -np.inf)
        names, best = known[0].copy(), known[1].copy()
        floor = best[:, -1].copy()  # never more than the k-th best score in all trees
        base = self.top**2 + (queries * queries).sum(axis=1)
        slack = 1e-6 * (np.sqrt(base) + self.top)
        across = np.ascontiguousarray(queries.T)
        # Two sums of the same products in any order differ by less than this.
        size = np.abs(queries).max(axis=1, initial=0) * np.abs(self.columns).max(initial=0)
        blur = 4 * queries.shape[1] ** 2 * np.finfo(np.float64).eps * size + np.finfo(np.float64).tiny
        made = 0

        def offer(rows: np.ndarray, score: np.ndarray, at: int) -> None:
            ids = self.ids[at : at + score.shape[1]]
            may = ~(score < (floor[rows] - blur[rows])[:, None])
            line, point = np.divmod(np.flatnonzero(may), len(ids))
            if len(line) > k:
                many = np.flatnonzero(np.bincount(line, minlength=len(rows)) > k + 1)
                if len(many):  # k of these that aren't the query's own are a bound for the others
                    some = np.where(may[many] & (ids != own[rows[many], None]), -score[many], np.inf)
                    least = -np.partition(some, k - 1, axis=1)[:, k - 1]
                    may[many] &= ~(score[many] < (least - 2 * blur[rows[many]])[:, None])
                    line, point = np.divmod(np.flatnonzero(may), len(ids))
            other = ids[point] != own[rows[line]]
            line, point = line[other], point[other]
            if not len(line):
                return
            if len(line) > may.size // 2:
                exact = products(queries[rows], self.columns[:, at : at + len(ids)].T)[line, point]
            else:
                exact = some_products(across, self.columns, rows[line], at + point)
            count = np.bincount(line, minlength=len(rows))
            to = np.flatnonzero(count)
            place = np.arange(len(line)) - np.repeat((np.cumsum(count) - count)[to], count[to])
            row = np.repeat(np.arange(len(to)), count[to])
            scores = np.full((len(to), k + count.max()), -np.inf)
            found = np.full(scores.shape, np.iinfo(np.int64).max)
            scores[:, :k], found[:, :k] = best[rows[to]], names[rows[to]]
            scores[row, k + place], found[row, k + place] = exact, ids[point]
            order = np.lexsort((found, -scores), axis=1)[:, :k]
            best[rows[to]], names[rows[to]] = np.take_along_axis(scores, order, 1), np.take_along_axis(found, order, 1)
            floor[rows[to]] = np.maximum(floor[rows[to]], best[rows[to], -1])

        def meet(rows: np.ndarray, at: int, end: int) -> np.ndarray:
            nonlocal made
            made += len(rows) * (end - at)
            return (queries if len(rows) == len(queries) else queries[rows]) @ self.columns[:, at:end]

        def distance(rows: np.ndarray, score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base[rows] - 2 * score, 0))

        def settle(number: int, rows: np.ndarray) -> None:
            """The leaf that a query lies in gives its first bound."""
            if not len(rows):
                return
            at, end, left, right, *ranges = self.nodes[number]
            score = meet(rows, int(at), int(end))
            if left >= 0:
                inside = distance(rows, score[:, 0]) <= (ranges[1] + ranges[2]) / 2
                settle(int(left), rows[inside])
                settle(int(right), rows[~inside])
            elif end - at >= k:
                score[self.ids[int(at) : int(end)] == own[rows, None]] = -np.inf
                floor[rows] = np.partition(score, -k, axis=1)[:, -k] - blur[rows]

        def visit(number: int, rows: np.ndarray) -> None:
            """Queries go through the tree together, so that products are few and large."""
            if not len(rows):
                return
            at, end, left, right, *ranges = self.nodes[number]
            score = meet(rows, int(at), int(end))
            offer(rows, score, int(at))
            if left < 0:
                return
            far = distance(rows, score[:, 0])
            for child, low, high in ((left, *ranges[:2]), (right, *ranges[2:])):
                with np.errstate(invalid="ignore"):
                    reach = distance(rows, floor[rows])
                visit(int(child), rows[np.maximum(np.maximum(far - high, low - far), 0) * factor <= reach + slack[rows]])

        if not bounded:
            settle(0, np.arange(len(queries)))
        visit(0, np.arange(len(queries)))
        return names, best, made


def _matrix(column: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float64).reshape(len(column), -1)


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, dim, tree): a tree for each shard of (vec_id, vec), all of one length of vectors."""
    rows = stored(rows.where("vec is not null and vec_id is not null").select("vec_id", "vec", F.monotonically_increasing_id().alias("serial")), "vp-rows")
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dim = F.octet_length("vec")

    def plant(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("serial")
        tree = Tree(group["vec_id"].to_numpy(np.int64), _matrix(group["vec"]))
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "dim": group["dim"].iloc[:1], "tree": [tree.pack()]})

    sharded = rows.select("vec_id", "vec", "serial", F.pmod(F.xxhash64("serial"), F.lit(shards)).alias("shard"), dim.alias("dim"))
    return sharded.groupBy("shard", "dim").applyInPandas(plant, "shard long, dim int, tree binary")


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, factor: float = FACTOR, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query (vec_id, vec), ties to the smaller id.

    Trees are dealt to tasks and stay there. Queries are packed into blocks, and a copy of each block goes to each task,
    where what it found in one tree is its bound in the next. A task holds its trees, of ``HELD`` bytes or one at least, and
    one block at a time.
    """
    queries = queries.where("vec is not null and vec_id is not null")
    queries = stored(queries.select(F.col("vec_id").alias("query_id"), "vec", F.octet_length("vec").alias("dim"), F.monotonically_increasing_id().alias("query")), "vp-queries")
    blocks = max(1, math.ceil(queries.count() / block))
    last, largest = index.agg(F.max("shard"), F.max(F.octet_length("tree"))).first()
    shards = (last or 0) + 1
    tasks = max(min(shards, TASKS), math.ceil(shards / max(1, HELD // (largest or 1))))
    row = F.struct("query", "query_id", "vec")
    packed = queries.groupBy("dim", F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block")).agg(F.collect_list(row).alias("rows"))
    each = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task")
    asking = packed.select(each, "dim", "block", F.lit(None).cast("binary").alias("tree"), "rows")
    task = F.pmod("shard", F.lit(tasks)).cast("int").alias("task")
    trees = index.select(task, "dim", F.lit(-1).cast("long").alias("block"), "tree", F.lit(None).cast(asking.schema["rows"].dataType).alias("rows"))
    # Each task is a partition of its own: the work of one doesn't show in its bytes.
    together = trees.unionByName(asking).repartitionById(tasks, F.col("task")).sortWithinPartitions("dim", "block")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], None
        for batch in batches:
            for i, here in enumerate(batch.column("dim").to_pylist()):
                if here != place:
                    held, place = [], here
                if batch.column("tree")[i].is_valid:
                    held.append(Tree.unpack(batch.column("tree")[i].as_py()))
                elif held:  # else the task has no vectors of this length
                    query, own, vec = batch.column("rows")[i].values.flatten()
                    ids, points, known = own.to_numpy(), _matrix(vec.to_pylist()), None
                    for tree in held:
                        known = tree.search(ids, points, k, factor, known)[:2]
                    names, scores = known
                    good = scores > -np.inf
                    line = np.repeat(np.arange(len(ids)), good.sum(axis=1))
                    found = [query.to_numpy()[line], ids[line], names[good], scores[good]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query", "query_id", "vec_id", "score"])

    found = together.mapInArrow(meet, "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = NEAREST, factor: float = FACTOR) -> DataFrame:
    """The k nearest by inner product of the rows whose vec_id is divisible by ``every``, among all rows.

    A query's own vec_id is no candidate; with fewer candidates all are returned. Rows without an id and
    vectors that are null, empty or zero, or hold a null or a value that isn't finite, take no part;
    vectors of different lengths don't meet. Rows that share an id are candidates, and queries, each.
    Other columns are left out. An empty table gives no rows.
    """
    ready(vectors.sparkSession)
    rows = stored(vector_rows(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), "vec"), "vp-vectors")
    index = stored(build_index(rows), "vp-index")
    return search(index, rows.where(F.pmod("vec_id", F.lit(every)) == 0), k, factor)
