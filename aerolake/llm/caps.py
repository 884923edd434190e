"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter is a direction put together from one code word for each block of (rotated) coordinates. A
vector goes to all filters whose inner product with it exceeds a bound, which list decoding
finds without looking at all products. Vectors that share a filter are compared by cosine. The bound is
set by the number of vectors, so that unrelated vectors seldom meet, and the number of filters by
the chance that a pair that is just similar enough meets in one of them.

Equal vectors are one class, counted with its size. A pair that meets in several filters counts in the
first of them only, so links are counted without listing them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from aerolake.llm.common import components, mapped, ready, stored, whole_groups

COSINE = 0.9
#: Unrelated vectors that a filter holds, on average.
CROWD = 0.25
#: Filters that a pair of just this cosine shares, on average over all codes.
SHARED = 16.0
#: Codes with rotations of their own. Filters of one code are no independent draws, so a pair that one code misses often should get others.
CODES = 8
#: Blocks of a code, at any size: filters of more and shorter blocks are more alike, and pairs that share none are far more.
BLOCKS = 2
#: Products of vectors and code words held at a time.
PRODUCTS = 1 << 20
#: Vectors of a filter that one task compares with each other.
CHUNK = 2048
#: Groups of this size at most are compared many at a time.
SMALL = 8


def _tail(low: np.ndarray, dim: int) -> np.ndarray:
    """The share of the unit sphere with a first coordinate of at least ``low``."""
    grid = np.linspace(-1, 1, 20_001)
    weight = np.maximum(1 - grid * grid, 0) ** ((dim - 3) / 2)
    above = np.append(np.cumsum(((weight[1:] + weight[:-1]) / 2)[::-1])[::-1], 0)
    return np.interp(np.clip(low, -1, 1), grid, above / above[0])


def caps(n: int, dim: int, cosine: float = COSINE) -> tuple[float, int]:
    """(bound, code words of a block) of each code for n vectors. A cap is never narrower than a link."""
    grid = np.linspace(0.05, 0.95, 1801)
    at = np.searchsorted(-_tail(grid, dim), -min(0.02, CROWD / max(n, 1)))
    bound = min(float(grid[min(at, len(grid) - 1)]), cosine)
    x = np.linspace(bound, 1, 2001)[:-1]
    weight = (1 - x * x) ** ((dim - 3) / 2)
    near = _tail((bound - cosine * x) / np.sqrt((1 - cosine**2) * (1 - x * x)), dim - 1)
    meets = float((weight * near).sum() / weight.sum()) * float(_tail(np.array([bound]), dim)[0])
    return bound, math.ceil((SHARED / CODES / meets) ** (1 / BLOCKS))


@lru_cache(maxsize=1)
def _code(number: int, dim: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and the code words of each block, the same in every worker; a worker holds one code at a time."""
    stream = np.random.Generator(np.random.PCG64([number, dim]))
    turn = np.linalg.qr(stream.standard_normal((dim, dim)))[0]
    code = [stream.standard_normal((words, len(part))) for part in np.array_split(np.arange(dim), BLOCKS)]
    return turn, [c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(BLOCKS) for c in code]


def decoded(products: list[np.ndarray], bound: float) -> np.ndarray:
    """Numbers of all filters whose products, one for each block's code word, add up to the bound."""
    sums, codes = np.zeros(1), np.zeros(1, dtype=np.int64)
    for b, own in enumerate(products):
        rest = sum(float(p.max()) for p in products[b + 1 :])
        order = np.argsort(-own)
        sizes = np.searchsorted(-own[order], sums - (bound - rest), side="right")
        at = np.repeat(np.arange(len(sums)), sizes)
        word = order[np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        sums, codes = sums[at] + own[word], codes[at] * len(own) + word
    return np.sort(codes)


def filters_of(vectors: np.ndarray, n: int, cosine: float) -> list[np.ndarray]:
    """The filters of each row."""
    dim = vectors.shape[1]
    if dim < 8:  # too few coordinates for a code: all meet in one filter
        return [np.zeros(1, dtype=np.int64) for _ in vectors]
    bound, words = caps(n, dim, cosine)
    rows = min(256, max(1, PRODUCTS // words))
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out: list[list[np.ndarray]] = [[] for _ in vectors]
    for number in range(CODES):
        turn, code = _code(number, dim, words)
        for at in range(0, len(units), rows):
            turned = units[at : at + rows] @ turn
            products = [part @ c.T for part, c in zip(np.array_split(turned, BLOCKS, axis=1), code)]
            for i in range(len(turned)):
                out[at + i].append(decoded([p[i] for p in products], bound) * CODES + number)
    return [np.concatenate(x) for x in out]


def _vector(values: list | None) -> bytes | None:
    """Doubles of a vector that takes part."""
    if not values or any(v is None for v in values):
        return None
    data = np.array(values, dtype=np.float64)
    with np.errstate(over="ignore"):
        good = np.isfinite(data).all() and 0 < np.linalg.norm(data) < np.inf
    return data.tobytes() if good else None


def vector_rows(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, vec): doubles of each vector that takes part, null for one that is null, zero or not finite."""
    return mapped(vectors, column, {"vec": BinaryType()}, lambda rows: [[_vector(v) for v in rows]], [id_column])


def _small_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    for size in range(2, SMALL + 1):
        at = starts[sizes == size]
        for i in range(size):
            for j in range(i + 1, size):
                left.append(at + i)
                right.append(at + j)
    return np.concatenate(left), np.concatenate(right)


def _islands(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the first row of its component."""
    label = np.arange(len(linked))
    while True:
        best = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, best)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _bucket(cosine: float):
    def of_group(vectors: np.ndarray, lists: list[np.ndarray], chunk: np.ndarray, cross: bool, here: int) -> tuple[np.ndarray, np.ndarray]:
        norms = np.linalg.norm(vectors, axis=1)
        close = vectors @ vectors.T / np.outer(norms, norms) >= cosine
        np.fill_diagonal(close, False)
        if cross:
            close &= chunk[:, None] != chunk[None, :]
        rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        earlier = np.concatenate(lists)
        rows, earlier = rows[earlier < here], earlier[earlier < here]
        _, column, count = np.unique(earlier, return_inverse=True, return_counts=True)
        useful = count[column] > 1
        place = np.cumsum(count > 1) - 1
        met = np.zeros((len(lists), int((count > 1).sum())), dtype=np.float32)
        met[rows[useful], place[column[useful]]] = 1
        close &= met @ met.T == 0
        return close, _islands(close)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, 2, 4096):
            code, ids, weight, chunk, cross = (table.column(c).to_numpy() for c in ("filter", "cls", "n", "chunk", "cross"))
            raw, lists = table.column("vec").to_pylist(), [np.frombuffer(x, dtype=np.int64) for x in table.column("filters").to_pylist()]
            links, parent = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
            sizes = np.diff(np.append(starts, len(ids)))
            width = np.array([len(v) for v in raw])
            matrix = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(ids), -1) if (width == width[0]).all() else None
            vectors = lambda at, end: matrix[at:end] if matrix is not None else np.array([np.frombuffer(v) for v in raw[at:end]])
            small = sizes <= SMALL if matrix is not None else np.zeros(len(sizes), dtype=bool)
            small &= ~cross[starts]
            left, right = _small_pairs(starts[small], sizes[small])
            more: list[tuple[int, int]] = []
            for at in range(0, len(left), 1 << 14):
                i, j = left[at : at + (1 << 14)], right[at : at + (1 << 14)]
                x, y = matrix[i], matrix[j]
                cos = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                more += zip(i[cos >= cosine].tolist(), j[cos >= cosine].tolist())
            for i, j in more:
                if np.intersect1d(lists[i], lists[j], assume_unique=True)[0] == code[i]:
                    links[i] += weight[j]
                    links[j] += weight[i]
            edges = [(i, j) for i, j in more]
            for at, size in zip(starts[~small], sizes[~small]):
                end = at + size
                close, label = of_group(vectors(at, end), lists[at:end], chunk[at:end], cross[at], code[at])
                links[at:end] += close @ weight[at:end]
                parent[at:end] = at + label
            a = np.concatenate([ids, ids[[i for i, _ in edges]] if edges else ids[:0]])
            b = np.concatenate([ids[parent], ids[[j for _, j in edges]] if edges else ids[:0]])
            count = np.concatenate([links, np.zeros(len(edges), dtype=np.int64)])
            told = (count > 0) | (a != b)
            yield pa.RecordBatch.from_arrays([pa.array(x[told]) for x in (a, b, count)], names=["a", "b", "links"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors (vec_id, embedding).

    Rows are linked by a cosine of at least ``cosine``, in double precision; all links reported are
    exact, and more than 99 of 100 links are found at just that cosine, nearly all above. Vectors
    that are null, empty or zero, or hold a null or a value that isn't finite, link with nothing, and
    so do vectors of different lengths. Repeated rows are vectors of their own and link with
    each other. component_id is the smallest vec_id that links reach; a row without an id has
    its links counted, and its own component_id is that of what it is linked with, null if that
    is nothing; kept is vec_id = component_id, true where both are null. Other columns are left out.
    An empty table gives no rows.
    """
    ready(vectors.sparkSession)
    rows = stored(vector_rows(vectors).select("vec_id", "vec", F.sha2("vec", 256).alias("key")), "caps-rows")
    classes = rows.where("vec is not null").groupBy("key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "caps-classes")
    n = classes.count()

    def step(raw: list[bytes]) -> list[list]:
        out: list = [None] * len(raw)
        sizes = np.array([len(v) for v in raw])
        for size in set(sizes.tolist()):
            at = np.flatnonzero(sizes == size)
            found = filters_of(np.array([np.frombuffer(raw[i]) for i in at]), n, cosine)
            for i, codes in zip(at, found):
                out[i] = np.sort(np.array([xxhash.xxh3_64_intdigest(c.tobytes(), seed=size) for c in codes], dtype=np.uint64).view(np.int64))
        return [out]

    lists = stored(mapped(classes, "vec", {"filters": ArrayType(LongType())}, step, ["cls"]), "caps-filters")
    members = lists.select("cls", F.explode("filters").alias("filter"))
    sizes = members.groupBy("filter").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = members.join(sizes, "filter").select("filter", "cls", F.ceil(F.col("size") / chunk).alias("chunks"))
    members = members.withColumn("chunk", F.pmod(F.xxhash64("cls"), "chunks"))
    # A vector of a crowded filter goes to the tasks of its chunk with each other chunk.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    members = members.select("filter", "cls", "chunk", "chunks", other)
    task = F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")
    packed = mapped(lists, "filters", {"filters": BinaryType()}, lambda rows: [[np.array(x, dtype=np.int64).tobytes() for x in rows]])
    carried = classes.select("cls", "n", "vec").join(packed, "cls")
    together = members.select("filter", task.alias("task"), "chunk", (F.col("chunk") != F.col("other")).alias("cross"), "cls").join(carried, "cls")
    together = together.select("filter", "task", "chunk", "cross", "cls", "n", "vec", "filters")
    together = together.repartition("filter", "task").sortWithinPartitions("filter", "task", "chunk", "cls")
    found = stored(together.mapInArrow(_bucket(cosine), "a long, b long, links long"), "caps-links")
    known = components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    named = classes.select("key", "cls", "node", "n").join(known.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("component", F.coalesce("component", "cls")).join(counts.withColumnRenamed("a", "cls"), "cls", "left")
    named = stored(named, "caps-named")
    smallest = named.groupBy("component").agg(F.min("node").alias("component_id"))
    result = named.join(smallest, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id")
    own = rows.select("vec_id", "key").join(result, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return own.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
