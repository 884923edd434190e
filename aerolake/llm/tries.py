"""The prefix trie of conversations, and totals of its subtrees by centroid decomposition.

A node is a distinct sequence of first turns. Its members share a hash of that sequence, and its smallest member and
its depth name it. A conversation owns the nodes that it is the smallest member of: the lower end of its path.

Subtree totals come from the forest of parent edges. A component is a connected part with a top. Its
centroid is the lowest node with at least half of the component below it; without it, the component falls into
the parts below the centroid's children and the part above, each of half the size at most. What a
part below holds in all, and the centroid itself, are added to the nodes on the path from the centroid to the
top. Components that are small enough are finished by one task each, in the same way. So there
are as many rounds as the logarithm of the size, be the trie a star or a single path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aerolake.llm.common import SPLIT, mapped, ready, stored, whole_groups

#: Conversations whose numbers are alike up to the last two digits begin alike.
FAMILY = 100
SHARED_TURNS = 6
#: Nodes of a component that one task finishes.
SMALL = 16_384
#: Depths of one block of a path, and ids of one piece of a list: what a task holds at once.
BLOCK = 4096


def running(rows: DataFrame, group: str, order: list[str], values: list[str]) -> DataFrame:
    """Each row with the sums of values (long, modulo 2^64) over its group up to itself, as sum_<value>, in order.

    Rows are dealt by ranges of group and order, so a group of any size lies in many tasks. A task sums by
    itself; then the group that goes on from the task before takes over what that one had. A number
    for each task goes through the driver.
    """
    ready(rows.sparkSession)
    spread = rows.repartitionByRange(group, *order, F.monotonically_increasing_id()).sortWithinPartitions(group, *order)
    names = [*rows.columns, *[f"sum_{v}" for v in values]]
    at = {name: i for i, name in enumerate(rows.columns)}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried, row = None, np.zeros(len(values), dtype=np.uint64), 0
        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column(at[group]).to_numpy(zero_copy_only=False)
            new = np.append(True, groups[1:] != groups[:-1])
            first = np.flatnonzero(new)
            own = np.cumsum(new) - 1
            out = []
            for k, v in enumerate(values):
                sums = np.cumsum(batch.column(at[v]).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                before = np.append(np.uint64(0), sums)[first]
                if groups[0] == last:
                    before[:1] -= carried[k : k + 1]
                sums -= before[own]
                out.append(sums)
            last, carried = groups[-1], np.array([s[-1] for s in out], dtype=np.uint64)
            places = pa.array(np.arange(row, row + len(batch)))
            row += len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(s.view(np.int64)) for s in out], places], names=[*names, "__row"])

    schema = StructType([*rows.schema.fields, *[StructField(n, LongType()) for n in names[len(rows.columns) :]]])
    local = spread.mapInArrow(summed, StructType([*schema.fields, StructField("__row", LongType())])).withColumn("__part", F.spark_partition_id())
    local = stored(local, "running")
    # The last row of a task has the sums of the group that may go on.
    last = F.struct(group, *[f"sum_{v}" for v in values])
    ends = local.groupBy("__part").agg(F.min(group).alias("low"), F.max_by(last, "__row").alias("last")).orderBy("__part").collect()
    carry, open_, total = [], None, np.zeros(len(values), dtype=np.uint64)
    for r in ends:
        if r["low"] == open_:
            carry.append((r["__part"], r["low"], [int(x) for x in total.view(np.int64)]))
        own = np.array(list(r["last"])[1:], dtype=np.int64).view(np.uint64)
        total = total + own if r["last"][0] == open_ else own
        open_ = r["last"][0]
    if not carry:
        return local.drop("__part", "__row")
    shift = dict((part, (low, np.array(sums, dtype=np.int64).view(np.uint64))) for part, low, sums in carry)

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            parts, groups = columns[-1].to_numpy(), columns[at[group]].to_numpy(zero_copy_only=False)
            sums = [c.to_numpy().view(np.uint64).copy() for c in columns[len(at) : len(names)]]
            for part in np.unique(parts):
                if (found := shift.get(int(part))) is not None:
                    mine = (parts == part) & (groups == found[0])
                    for k, s in enumerate(sums):
                        s[mine] += found[1][k]
            yield pa.RecordBatch.from_arrays([*columns[: len(at)], *[pa.array(s.view(np.int64)) for s in sums]], names=names)

    return local.mapInArrow(shifted, schema)


def _hashed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, two halves of a hash of role and text, and the text's code points."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    both = rows.select("conv_id", "turn", F.length("text").cast("long").alias("chars"), F.concat(F.length("role").cast("string"), F.lit(" "), "role", "text").alias("both"))

    def step(values: list[str]) -> list[list]:
        halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(v.encode()) for v in values), dtype="<i8").reshape(-1, 2)
        return [halves[:, 0], halves[:, 1]]

    return mapped(both, "both", {"low": LongType(), "high": LongType()}, step, ["conv_id", "turn", "chars"])


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, chars, low, high): the turns of each rebuilt conversation from depth 1 on, and one of depth 0 without text.

    low and high are hashes of the turn.
    """
    ordered = running(_hashed(turns).withColumn("one", F.lit(1).cast("long")), "conv_id", ["turn", "low", "high"], ["one"])
    own = stored(ordered.select("conv_id", (F.col("sum_one") - 1).alias("place"), "chars", "low", "high"), "trie-turns")
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED_TURNS))
    ids = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "shared": shared})
    ids = stored(ids, "trie-ids")
    # The first turns of a base: few rows for each, asked for by its family alone.
    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS - 1))
    begun = ids.join(heads.withColumnRenamed("conv_id", "base"), "base").where(F.col("place") < F.col("shared"))
    begun = begun.select("conv_id", (F.col("place") + 1).alias("depth"), "chars", "low", "high")
    bases = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    moved = ids.join(bases, "base", "left").select("conv_id", "n", "shared", F.least("shared", F.coalesce("base_n", F.lit(0))).alias("kept"))
    # Turns may be many for one conversation, what they ask for is one row: the turns lie in blocks.
    blocks = _in_blocks(moved, F.lit(0).cast("long"), F.col("n"))
    went_on = own.withColumn("block", _block("place")).join(blocks.drop("n"), ["conv_id", "block"]).where(F.col("place") >= F.col("shared"))
    went_on = went_on.select("conv_id", (F.col("kept") + F.col("place") - F.col("shared") + 1).alias("depth"), "chars", "low", "high")
    zero = F.lit(0).cast("long")
    roots = ids.select("conv_id", zero.alias("depth"), zero.alias("chars"), zero.alias("low"), zero.alias("high"))
    return roots.unionByName(begun).unionByName(went_on)


def _block(place: str) -> Column:
    return F.shiftright(F.col(place), 12)


def _in_blocks(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """A row for each block of places from first to last."""
    return rows.withColumn("block", F.explode(F.sequence(F.shiftright(first, 12), F.shiftright(last, 12))))


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, chars, node_conv, n_convs): the nodes on each conversation's path."""
    rows = rebuilt(turns)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column(1).to_numpy().view(np.uint64)
            columns = list(batch.columns)
            for k in (3, 4):
                x = columns[k].to_numpy().view(np.uint64) + (depth + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                columns[k] = pa.array((x ^ (x >> np.uint64(31))).view(np.int64))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    # Each turn's hash, mixed with its depth, is added up along the path: 128 bits for each prefix.
    sums = running(rows.mapInArrow(placed, rows.schema), "conv_id", ["depth"], ["low", "high"])
    prefix = ["depth", "sum_low", "sum_high"]
    parted = stored(sums.select("conv_id", "chars", *prefix, F.pmod(F.xxhash64("conv_id"), F.lit(SPLIT)).alias("part")), "trie-prefixes")
    partial = parted.groupBy(*prefix, "part").agg(F.min("conv_id").alias("node_conv"), F.count(F.lit(1)).alias("n_convs"))
    nodes = partial.groupBy(*prefix).agg(F.min("node_conv").alias("node_conv"), F.sum("n_convs").alias("n_convs"), F.collect_list("part").alias("parts"))
    nodes = nodes.select(*prefix, "node_conv", "n_convs", F.explode("parts").alias("part"))
    return parted.join(nodes, [*prefix, "part"]).select("conv_id", "depth", "chars", "node_conv", "n_convs")


def _finished(parents: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Subtree totals of one component by centroid decomposition; nodes lie parents first, the first is the top."""
    totals = np.zeros_like(weights)
    parent = parents.tolist()
    open_ = [list(range(len(parent)))]
    while open_:
        nodes = open_.pop()
        if len(nodes) == 1:
            totals[nodes[0]] += weights[nodes[0]]
            continue
        inside, size = dict.fromkeys(nodes, 0), 0
        for v in reversed(nodes):
            inside[v] += 1
            if v != nodes[0]:
                inside[parent[v]] += inside[v]
        centroid = max((v for v in nodes if 2 * inside[v] >= len(nodes)), key=lambda v: (-inside[v], v))
        # The part that a node falls into: above, or below a child of the centroid.
        part: dict[int, int] = {}
        parts: dict[int, list[int]] = {}
        for v in nodes:
            if v != centroid:
                p = part.get(parent[v], nodes[0])
                part[v] = v if v != nodes[0] and parent[v] == centroid else p
                parts.setdefault(part[v], []).append(v)
        above = nodes[0] if centroid != nodes[0] else None
        size = weights[centroid].copy()
        for top, own in parts.items():
            if top != above:
                size += weights[own].sum(axis=0)
        v = centroid
        while True:
            totals[v] += size
            if v == nodes[0]:
                break
            v = parent[v]
        open_ += parts.values()
    return totals


def _small_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(node_conv, depth, values): subtree totals within components that fit into a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, 2):
            conv, depth, parent = (table.column(c).to_numpy() for c in ("node_conv", "depth", "parent_conv"))
            weights = np.stack([table.column(v).to_numpy() for v in values], axis=1)
            out = np.zeros_like(weights)
            for at, end in zip(starts, np.append(starts[1:], len(table))):
                place = {(c, d): i for i, (c, d) in enumerate(zip(conv[at:end].tolist(), depth[at:end].tolist()))}
                up = [0] + [place[p, d - 1] for p, d in zip(parent[at + 1 : end].tolist(), depth[at + 1 : end].tolist())]
                out[at:end] = _finished(np.array(up), weights[at:end])
            columns = [pa.array(conv), pa.array(depth), *[pa.array(out[:, k]) for k in range(len(values))]]
            yield pa.RecordBatch.from_arrays(columns, names=["node_conv", "depth", *values])

    rows = nodes.select("top_conv", "top_depth", "depth", "node_conv", F.coalesce("parent_conv", F.lit(0)).alias("parent_conv"), *values)
    together = rows.repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth", "depth", "node_conv")
    return together.mapInArrow(run, "node_conv long, depth long, " + ", ".join(f"{v} long" for v in values))


def subtree_totals(along: DataFrame, values: list[str], small: int = SMALL) -> DataFrame:
    """(node_conv, depth, values) with the sums of values over each node's subtree.

    ``along`` has (conv_id, depth, node_conv, parent_conv, values): each path that owns nodes, node by node, with the values of its
    nodes and, where it owns them, their parents. A component is named by its top.
    """
    own = F.col("conv_id") == F.col("node_conv")
    ends = along.groupBy("conv_id").agg(F.min(F.when(own, F.col("depth"))).alias("first_own"), F.max("depth").alias("last"))
    facts = _in_blocks(ends, F.lit(0).cast("long"), F.col("last"))
    rows = along.withColumn("block", _block("depth")).join(facts, ["conv_id", "block"])
    top = along.where("depth = 0").agg(F.min("node_conv")).first()[0]
    top_columns = {"top_conv": F.lit(top).cast("long"), "top_depth": F.lit(0).cast("long")}
    open_ = stored(rows.withColumns(top_columns), "trie-open")
    comp = ["top_conv", "top_depth"]
    done: list[DataFrame] = []
    while True:
        sizes = open_.where(own).groupBy(*comp).agg(F.count(F.lit(1)).alias("nodes"))
        large = stored(sizes.where(F.col("nodes") > small), "trie-large")
        little = open_.where(own).join(large, comp, "left_anti")
        done.append(_small_totals(little, values))
        if large.isEmpty():
            break
        open_ = open_.join(large, comp)
        # How much of the component lies below a node: of each path, the nodes it owns from there on.
        below = F.greatest(F.lit(0), F.col("last") - F.greatest("first_own", "depth") + 1)
        part = F.pmod(F.xxhash64("conv_id"), F.lit(SPLIT))
        sizes = open_.groupBy(*comp, "nodes", "node_conv", "depth", part.alias("part")).agg(F.sum(below).alias("below"))
        sizes = sizes.groupBy(*comp, "nodes", "node_conv", "depth").agg(F.sum("below").alias("below")).where("2 * below >= nodes")
        centroids = sizes.groupBy(*comp).agg(F.max("depth").alias("at"), F.max_by("node_conv", "depth").alias("centroid"))
        centroids = stored(centroids, "trie-centroids")
        # Paths through the centroid, and the child by which they leave it.
        near = open_.join(centroids, comp).where(F.col("depth").between(F.col("at"), F.col("at") + 1))
        through = near.groupBy(*comp, "conv_id", "at", "centroid").agg(
            F.bool_or((F.col("depth") == F.col("at")) & (F.col("node_conv") == F.col("centroid"))).alias("passes"),
            F.max(F.when(F.col("depth") > F.col("at"), F.col("node_conv"))).alias("child"), F.max("last").alias("end"),
        ).where("passes")
        through = stored(_in_blocks(through.drop("passes"), F.col("top_depth"), F.col("end")).drop("end"), "trie-through")
        split = stored(open_.drop("nodes").join(through, [*comp, "conv_id", "block"], "left"), "trie-split")
        passes, lower = F.col("at").isNotNull(), F.col("depth") >= F.col("at")
        held = split.where(passes & lower & own).groupBy(*comp).agg(*[F.sum(v).alias(v) for v in values])
        chain = split.where(passes & (F.col("depth") <= F.col("at")) & (F.col("conv_id") == F.col("centroid"))).select(*comp, "node_conv", "depth")
        done.append(stored(chain.join(held, comp).select("node_conv", "depth", *values), "trie-added"))
        under = passes & (F.col("depth") > F.col("at"))
        open_ = stored(
            split.where(~passes | (F.col("depth") != F.col("at"))).select(
                "conv_id", "block", "depth", "node_conv", "parent_conv", *values, "first_own",
                F.when(passes & ~lower, F.col("at") - 1).otherwise(F.col("last")).alias("last"),
                F.when(under, F.col("child")).otherwise(F.col("top_conv")).alias("top_conv"),
                F.when(under, F.col("at") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            ), "trie-open",
        )
    added = done[0]
    for more in done[1:]:
        added = added.unionByName(more)
    return added.groupBy("node_conv", "depth").agg(*[F.sum(v).alias(v) for v in values])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node_conv, depth, ends_sha256) of rows (node_conv, depth, conv_id): the SHA-256 of the ids, ascending, with commas between.

    Ids of one node lie in several tasks, which write pieces of the list; the pieces go through the hash in order.
    """
    keys = ["node_conv", "depth"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, depth, ids = (batch.column(k).to_numpy() for k in range(3))
            new = np.append(True, (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) if len(ids) else np.zeros(0, dtype=bool)
            first = np.flatnonzero(new)
            texts = [",".join(map(str, own.tolist())) for own in np.split(ids, first[1:])] if len(ids) else []
            yield pa.RecordBatch.from_arrays([pa.array(conv[first]), pa.array(depth[first]), pa.array(ids[first]), pa.array(texts, pa.string())], names=[*keys, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for conv, depth, text in zip(*[batch.column(c).to_pylist() for c in (*keys, "ids")]):
                if (conv, depth) == current:
                    state.update(b",")
                else:
                    if current:
                        out.append((*current, state.hexdigest()))
                    current, state = (conv, depth), hashlib.sha256()
                state.update(text.encode())
            yield _digests(out)
        yield _digests([(*current, state.hexdigest())] if current else [])

    def _digests(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[*keys, "ends_sha256"])

    spread = ends.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    listed = stored(spread.mapInArrow(pieces, "node_conv long, depth long, first long, ids string"), "trie-ends")
    return listed.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(hashed, "node_conv long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, small: int = SMALL) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    Turns are ordered by turn, null first, those with the same turn by a hash of role and text; repeated rows are turns
    each; null role or text is empty. The first turns, as many as a hash of the id says, are those of the first conversation of the
    hundred; own turns follow. Rows without conv_id are left out, so are other columns. n_leaves counts childless nodes of the subtree,
    saved_tokens adds up, over the subtree, the code points of each node's last text times its members but one.
    ends_sha256 is that of the ids of members that end at the node. An empty table gives no rows.
    """
    along = stored(paths(turns), "trie-paths")
    own = F.col("conv_id") == F.col("node_conv")
    parents = along.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node_conv").alias("parent_conv"))
    nodes = along.where(own).join(parents, ["conv_id", "depth"], "left").select("node_conv", "depth", "chars", "n_convs", "parent_conv")
    children = nodes.where("parent_conv is not null").groupBy(F.col("parent_conv").alias("node_conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["node_conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = stored(nodes, "trie-nodes")
    if nodes.isEmpty():
        totals = nodes.select("node_conv", "depth", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    else:
        values = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")}
        owned = nodes.withColumns(values).select(F.col("node_conv").alias("conv_id"), "depth", "parent_conv", *values)
        owners = owned.select("conv_id").distinct()
        # Paths that own no node are copies: they say nothing about the trie's shape.
        routes = along.select("conv_id", "depth", "node_conv").join(owners, "conv_id", "left_semi").join(owned, ["conv_id", "depth"], "left")
        totals = subtree_totals(routes.na.fill(0, list(values)), list(values), small)
    last = along.groupBy("conv_id").agg(F.max(F.struct("depth", "node_conv")).alias("end"))
    ends = ends_digest(last.select("end.node_conv", "end.depth", "conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(totals, ["node_conv", "depth"]).join(ends, ["node_conv", "depth"], "left")
        .select(
            F.col("node_conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
