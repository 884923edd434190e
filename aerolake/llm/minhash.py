"""Near-duplicate documents: MinHash bands, Bayesian pruning in batches, exact confirmation.

Documents with the same shingle set are one class, and what follows works on classes.
A word is 128 bits of a hash: candidates are found by one half of them and confirmed by the other.
Classes that agree on a band share a bucket. Inside a bucket, a pivot is compared with the
others, one batch of signature bytes after the other; a pair goes when the posterior chance
that it is similar enough falls below the miss probability. Those that survive are
confirmed on the full sets.

Only what is connected matters, so no step lists all pairs of a group. In a bucket, each class is tied
to one pivot that it survives against; buckets whose ties leave several families are
searched once more for surviving pairs between them. So no surviving pair is split between
families, and families, in chunks, are where full sets are compared: pairs that confirmed links
already connect are skipped, all others are compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType
from pyspark.sql.window import Window

from aerolake.llm.common import components, mapped, ready, stored, whole_groups

WORDS = 5
SIMILARITY = 80
HASHES = 128
#: Chance that a pair just similar enough shares no band, and that it is pruned before it is confirmed.
BAND_MISS = 1e-6
PRUNE_MISS = 1e-6
#: Looks at a pair's signature before it is confirmed.
LOOKS = 5
#: Classes of a bucket or family, and shingles of a family, that one task compares with each other.
CHUNK = 1024
CHUNK_SHINGLES = 1 << 20
#: Rows that a task writes after it compared them or made their sets.
TASK_ROWS = 1 << 14
#: Classes of a large family that are compared with all its chunks first.
PIVOTS = 8

_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_STREAM = np.random.Generator(np.random.PCG64(20240229))
_SCALE = _STREAM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _STREAM.integers(0, 1 << 64, HASHES, dtype=np.uint64)
_BASE = np.uint64(0xD1342543DE82EF95)
_SLICE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_keys(text: bytes) -> np.ndarray:
    """128 bits of each word, with A-Z in lower case, as two columns of 64."""
    out, at = [], 0
    while at < len(text):
        cut = _BLANK.search(text, min(len(text), at + _SLICE))
        end = cut.start() if cut else len(text)
        out.append(b"".join(map(xxhash.xxh3_128_digest, text[at:end].lower().split())))
        at = end
    return np.frombuffer(b"".join(out), dtype="<u8").reshape(-1, 2)


def word_hashes(text: bytes) -> np.ndarray:
    """64 bits of each word, with A-Z in lower case."""
    return word_keys(text)[:, 0]


def _runs(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the distinct runs of so many words, sorted; of all words, if there are fewer; none without words."""
    size = min(words, len(hashes))
    if not size:
        return np.zeros(0, dtype=np.uint64)
    runs = hashes[: len(hashes) - size + 1] + np.uint64(size)
    for k in range(1, size):
        runs = mix(runs * _BASE + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(mix(runs))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The set by which candidates are found."""
    return _runs(word_hashes((text or "").encode()), words)


def shingle_check(text: str | None, words: int) -> np.ndarray:
    """The same set by other bits of the words: confirming on it leaves no link to a chance of the first."""
    return _runs(word_keys((text or "").encode())[:, 1], words)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    least = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        values = np.multiply.outer(_SCALE, shingles[at : at + 1024])
        values += _SHIFT[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return mix(least)


def rows_of_band(similarity: float) -> int:
    """The longest bands that miss a pair of just this similarity with BAND_MISS at most."""
    fit = [r for r in range(1, 17) if (1 - similarity**r) ** (HASHES // r) <= BAND_MISS]
    return max(fit, default=1)


def least_matches(similarity: float, miss: float = PRUNE_MISS, looks: int = LOOKS) -> list[tuple[int, int]]:
    """(bytes compared, fewest equal ones) of each look.

    The prior of the similarity is uniform. Two bytes of a signature are equal with chance p = s + (1 - s) / 256,
    so p is uniform from 1 / 256 to 1, and with m equal of n the posterior has weight
    p^m (1 - p)^(n - m). A pair with fewer matches has a chance below ``miss`` of being similar enough.
    """
    grid = (np.arange(1 << 16) + 0.5) / (1 << 16) * (255 / 256) + 1 / 256
    high = grid >= similarity + (1 - similarity) / 256
    out = []
    for look in range(1, looks + 1):
        n = HASHES * look // looks
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(logs - logs.max())
            if weight[high].sum() >= miss * weight.sum():
                break
        out.append((n, m))
    return out


def surviving(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signature rows pass all looks."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), dtype=np.int64), 0
    for n, least in bounds:
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        good = matches >= least
        alive, matches, done = alive[good], matches[good], n
    return alive


def _by_agreement(sigs: np.ndarray) -> np.ndarray:
    """Rows of a bucket, those most like the bucket as a whole first."""
    common = np.array([np.bincount(c, minlength=256).argmax() for c in sigs.T], dtype=np.uint8)
    return np.argsort(-(sigs == common).sum(axis=1), kind="stable")


def pivot_links(ids: np.ndarray, sigs: np.ndarray, starts: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (pivot row, row) and the pivots of each group.

    The first row that is left becomes a pivot; rows that survive against it are linked and
    leave. It goes on until no row is left.
    """
    sizes = np.diff(np.append(starts, len(ids)))
    order = np.arange(len(ids))
    for at, size in zip(starts[sizes > 8], sizes[sizes > 8]):
        order[at : at + size] = at + _by_agreement(sigs[at : at + size])
    group = np.repeat(np.arange(len(starts)), sizes)
    left, right, heads = [], [], []
    while len(order):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        heads.append(order[first])
        pivot = np.repeat(order[first], np.diff(np.append(first, len(order))))
        rest = np.delete(np.arange(len(order)), first)
        linked = np.zeros(len(order), dtype=bool)
        for at in range(0, len(rest), 1 << 16):
            part = rest[at : at + (1 << 16)]
            linked[part[surviving(sigs[pivot[part]], sigs[order[part]], bounds)]] = True
        left.append(pivot[linked])
        right.append(order[linked])
        stay = ~linked
        stay[first] = False
        order, group = order[stay], group[stay]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=int)
    return join(left), join(right), join(heads)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), HASHES)


def _chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """Rows (bucket, node, sig) of buckets with several nodes, with a chunk number, together and in order."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk)
    return rows.join(sizes, "bucket").select("bucket", F.pmod(F.xxhash64("node"), chunks).alias("chunk"), "node", "n")


def _first_pass(members: DataFrame, sigs: DataFrame, bounds: list[tuple[int, int]], chunk: int) -> DataFrame:
    """(bucket, a, b, n): links to pivots; b is null for the pivots themselves of buckets with several chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, 2):
            ids, n, bucket = (table.column(c).to_numpy() for c in ("node", "n", "bucket"))
            left, right, heads = pivot_links(ids, _matrix(table.column("sig")), starts, bounds)
            heads = heads[n[heads] > chunk]
            a, b = np.append(ids[left], ids[heads]), np.append(ids[right], np.zeros(len(heads), dtype=np.int64))
            none = np.append(np.zeros(len(left), dtype=bool), np.ones(len(heads), dtype=bool))
            own = np.append(left, heads)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[own]), pa.array(a), pa.array(b, mask=none), pa.array(n[own])], names=["bucket", "a", "b", "n"])

    rows = _chunked(members, chunk).join(sigs, "node").select("bucket", "chunk", "node", "n", "sig")
    together = rows.repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", "node")
    return together.mapInArrow(run, "bucket long, a long, b long, n long")


def _between_families(members: DataFrame, families: DataFrame, sigs: DataFrame, bounds: list[tuple[int, int]], chunk: int, places: int) -> DataFrame:
    """(a, b): for each bucket, surviving pairs that connect what families of it survive against each other.

    Classes outside the bucket's largest family meet all classes of the bucket, a chunk with a chunk at a time.
    """
    rows = members.join(families, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("part"))
    rows = _asking(rows.withColumn("room", F.lit(1 / chunk)), "bucket", F.ceil(F.col("n") / chunk), places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, 3):
            ids, part, asks = (table.column(c).to_numpy() for c in ("node", "part", "asks"))
            matrix, out = _matrix(table.column("sig")), []
            for at, end in zip(starts, np.append(starts[1:], len(ids))):
                label, there = np.unique(part[at:end], return_inverse=True)[1], ~asks[at:end]
                for i in np.flatnonzero(asks[at:end]):
                    other = np.flatnonzero(there & (label != label[i]))
                    other = other[surviving(np.broadcast_to(matrix[at + i], (len(other), HASHES)), matrix[at + other], bounds)]
                    for o in other:
                        if label[o] != label[i]:
                            out.append((ids[at + i], ids[at + o]))
                            label[label == label[o]] = label[i]
            yield _pairs(out)

    together = rows.join(sigs, "node").select("bucket", "ask", "chunk", "node", "part", "asks", "sig")
    return together.repartition("bucket", "ask", "chunk").sortWithinPartitions("bucket", "ask", "chunk", "node").mapInArrow(run, "a long, b long")


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _asking(rows: DataFrame, group: str, chunks: Column, size: int | None = None) -> DataFrame:
    """(group, ask, chunk, node, part, asks): of groups with several parts, each chunk of those outside the largest part with each chunk of all.

    ``chunks`` is the number of chunks, from the number ``n`` of a group's rows; ``room`` of a row is the
    share of a chunk that it takes, ``size`` bounds the rows where it is known. So (group, ask, chunk), which is one task, holds two chunks.
    """
    largest = F.struct("size", "part")
    parts = rows.groupBy(group, "part").agg(F.count(F.lit(1)).alias("size"), F.sum("room").alias("room"))
    main = parts.groupBy(group).agg(
        F.max(largest).alias("main"), F.sum("size").alias("n"), F.count(F.lit(1)).alias("parts"), (F.sum("room") - F.max_by("room", largest)).alias("asking")
    ).where("parts > 1")
    rows = rows.join(main, group).withColumn("chunks", chunks.cast("long"))
    askers = F.greatest(F.lit(1), F.least("chunks", F.ceil("asking"))).cast("long").alias("askers")
    rows = stored(rows.select(group, "node", "part", "chunks", askers, (F.col("part") != F.col("main.part")).alias("small")), "minhash-open", size)
    place = lambda count: F.pmod(F.xxhash64("node"), count)
    right = rows.select(group, _each("askers").alias("ask"), place("chunks").alias("chunk"), "node", "part", F.lit(False).alias("asks"))
    left = rows.where("small").select(group, place("askers").alias("ask"), _each("chunks").alias("chunk"), "node", "part", F.lit(True).alias("asks"))
    return right.unionByName(left)


def _each(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))


def _confirm(rows: DataFrame, facts: DataFrame, bounds: list[tuple[int, int]], similarity: int) -> DataFrame:
    """(a, b): exact links of (family, ask, chunk, node, part, asks, there) that connect parts.

    Those that ask are compared with the rows there of another part, unless links found before
    connect them already: by size, by signature, then on the full sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, 3, 2 * CHUNK):
            ids, part, asks, there = (table.column(c).to_numpy() for c in ("node", "part", "asks", "there"))
            raw, matrix, out = table.column("shingles").to_pylist(), _matrix(table.column("sig")), []
            for at, end in zip(starts, np.append(starts[1:], len(ids))):
                label = np.unique(part[at:end], return_inverse=True)[1]
                sizes = np.array([len(x) // 8 for x in raw[at:end]])
                stops = np.cumsum(sizes)
                items = np.unique(np.frombuffer(b"".join(raw[at:end]), dtype=np.int64), return_inverse=True)[1]
                sets = np.split(items, stops[:-1])
                held = np.zeros(len(items), dtype=bool)
                sigs, here = matrix[at:end], there[at:end]
                order = _by_agreement(sigs)
                for i in order[asks[at:end][order]]:
                    other = np.flatnonzero(here & (label != label[i]))
                    small, large = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
                    other = other[100 * small >= similarity * large]
                    other = other[surviving(np.broadcast_to(sigs[i], (len(other), HASHES)), sigs[other], bounds)]
                    held[sets[i]] = True
                    for o in other:
                        if label[o] != label[i]:
                            shared = int(held[sets[o]].sum())
                            if 100 * shared >= similarity * (int(sizes[i]) + int(sizes[o]) - shared):
                                out.append((ids[at + i], ids[at + o]))
                                label[label == label[o]] = label[i]
                    held[sets[i]] = False
            yield _pairs(out)

    together = rows.join(facts, "node").select("family", "ask", "chunk", "node", "part", "asks", "there", "sig", "shingles")
    return together.repartition("family", "ask", "chunk").sortWithinPartitions("family", "ask", "chunk", "node").mapInArrow(run, "a long, b long")


def _links(families: DataFrame, docs: DataFrame, classes: DataFrame, bounds: list[tuple[int, int]], words: int, similarity: int, chunk: int, size: int) -> DataFrame:
    """(a, b): exact links, or what they connect, of the classes (node, component) of each family."""
    texts = docs.join(families.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = mapped(texts, "text", {"shingles": BinaryType()}, lambda ts: [[shingle_check(t, words).tobytes() for t in ts]])
    facts = stored(sets.dropDuplicates().withColumnRenamed("doc_id", "node").join(classes.select("node", "sig"), "node"), "minhash-facts", size, TASK_ROWS)
    sized = families.withColumnRenamed("component", "family").join(facts.select("node", F.octet_length("shingles").alias("bytes")), "node")
    sizes = sized.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    sizes = sizes.select("family", F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("bytes") / (8 * CHUNK_SHINGLES))).alias("chunks"))
    room = F.greatest(F.count(F.lit(1)) / chunk, F.sum("bytes") / (8 * CHUNK_SHINGLES)).alias("room")
    rows = sized.groupBy("family", "node").agg(room).join(sizes, "family").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    rows = stored(rows, "minhash-families", size)
    alone = rows.select("family", F.lit(0).cast("long").alias("ask"), "chunk", "node", F.col("node").alias("part"), F.lit(True).alias("asks"), F.lit(True).alias("there"))
    found = stored(_confirm(alone, facts, bounds, similarity), "minhash-links", size, TASK_ROWS)
    large = rows.where("chunks > 1")
    if large.isEmpty():
        return found
    # What chunks found by themselves is connected by those that had most links, then compared across chunks.
    tied = found.select(F.col("a").alias("node")).join(large, "node").groupBy("family", "chunks", "node").agg(F.count(F.lit(1)).alias("ties"))
    best = Window.partitionBy("family").orderBy(F.desc("ties"), "node")
    pivots = tied.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= PIVOTS).select("family", "node", _each("chunks").alias("chunk"))

    def in_parts(rows: DataFrame, known: DataFrame) -> DataFrame:
        return rows.join(known, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")

    columns = ["family", "ask", "chunk", "node", "part", "asks", "there"]
    asking = pivots.withColumns({"asks": F.lit(True), "there": F.lit(False)})
    staying = large.withColumns({"asks": F.lit(False), "there": F.lit(True)})
    known = stored(components(found), "minhash-parts", size)
    given = ["family", "chunk", "node", "asks", "there"]
    both = in_parts(asking.select(given).unionByName(staying.select(given)), known).withColumn("ask", F.lit(0).cast("long"))
    tied = stored(_confirm(both.select(columns), facts, bounds, similarity), "minhash-links", size, TASK_ROWS)
    known = stored(components(_stars(known).unionByName(tied)), "minhash-parts", size)
    open_ = _asking(in_parts(large.select("family", "node", "chunks", "room"), known), "family", F.col("chunks"), size).withColumn("there", ~F.col("asks"))
    return _stars(known).unionByName(stored(_confirm(open_.select(columns), facts, bounds, similarity), "minhash-links"))


def _stars(known: DataFrame) -> DataFrame:
    """(a, b): a link from each node to its component, which says as much as all links that led there."""
    return known.select(F.col("node").alias("a"), F.col("component").alias("b"))


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, chunk: int = CHUNK, band_rows: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs (doc_id, text).

    Words are split at ASCII blanks and compared with A-Z in lower case. Documents are linked if
    100 * shared shingles >= similarity * all shingles of both. component_id is the smallest doc_id
    that links reach, kept marks it. Null, empty and blank texts have no shingles and link with
    nothing. Rows that share a doc_id are one document, linked by any of their texts. A row without an id
    takes no part: its component_id is null and it is kept. Repeated rows give repeated results. Other
    columns of the input are left out. An empty table gives no rows.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    per_band = band_rows or rows_of_band(similarity / 100)
    bounds = least_matches(similarity / 100)

    def step(texts: list[str | None]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for text in texts:
            keys = word_keys((text or "").encode())
            shingles = _runs(keys[:, 0], words)
            out[0].append(len(shingles))
            if not len(shingles):
                for column in out[1:]:
                    column.append(None)
                continue
            least = signature(shingles)
            bands = np.arange(HASHES // per_band, dtype=np.uint64)
            for k in range(per_band):
                bands = mix(bands * _BASE + least[k::per_band][: len(bands)])
            out[1].append(xxhash.xxh3_128_digest(shingles.tobytes() + _runs(keys[:, 1], words).tobytes()))
            out[2].append(bands.view(np.int64))
            out[3].append(least.astype(np.uint8).tobytes())
        return out

    made = {"n_shingles": LongType(), "key": BinaryType(), "bands": ArrayType(LongType()), "sig": BinaryType()}
    rows = stored(mapped(docs, "text", made, step, ["doc_id"]), "minhash-rows")
    size = rows.count()  # bounds classes, components and, times bands, members
    places = size * (HASHES // per_band)
    classes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = stored(classes, "minhash-classes", size, TASK_ROWS)
    sigs = classes.select("node", "sig")
    members = stored(_several(classes.select(F.explode("bands").alias("bucket"), "node")), "minhash-members", places)

    found = stored(_first_pass(members, sigs, bounds, chunk), "minhash-links", places, TASK_ROWS)
    links = found.where("b is not null").select("a", "b")
    live = found.select("bucket")
    heads = found.where("b is null").select("bucket", F.col("a").alias("node")).distinct()
    waiting, before = heads.count(), None
    while waiting and waiting != before:  # pivots that stay apart are left to the second pass
        level = stored(_first_pass(_several(heads), sigs, bounds, chunk), "minhash-heads", waiting, TASK_ROWS)
        links = links.unionByName(level.where("b is not null").select("a", "b"))
        heads = level.where("b is null").select("bucket", F.col("a").alias("node")).distinct()
        waiting, before = heads.count(), waiting
    ties = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-ties", places)
    families = stored(components(ties), "minhash-apart", size)
    more = _between_families(members.join(live.distinct(), "bucket", "left_semi"), families, sigs, bounds, chunk, places)
    more = stored(more, "minhash-more", places, TASK_ROWS)
    if not more.isEmpty():
        families = stored(components(_stars(families).unionByName(more)), "minhash-together", size)
    links = _links(families, docs, classes, bounds, words, similarity, chunk, size).unionByName(_same_id(rows, classes))
    known = stored(components(links), "minhash-known", size)
    reps = classes.select("key", "node").join(known, "node", "left").select("key", F.coalesce("component", "node").alias("rep"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
    return (
        rows.select("doc_id", "n_shingles", "key").join(reps, "key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    )


def _same_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that have several texts."""
    several = rows.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("doc_id")
    return rows.join(several, "doc_id", "left_semi").join(classes, "key").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))


def _several(members: DataFrame) -> DataFrame:
    """Distinct (bucket, node) of buckets with more than one node."""
    sizes = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("bucket")
    return members.join(sizes, "bucket", "left_semi")
